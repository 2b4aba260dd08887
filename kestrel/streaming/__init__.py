from kestrel.streaming.stream import (
    prepare,
    read_csv_stream,
    run_batches,
    score_stream,
    train_per_batch,
    write_epoch,
)

__all__ = ["prepare", "read_csv_stream", "run_batches", "score_stream", "train_per_batch", "write_epoch"]
