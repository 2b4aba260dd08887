from kestrel.sources.schemas import ACCIDENTS_SCHEMA, ENCODED_ACCIDENTS_SCHEMA, NODE_FEATURES_SCHEMA
from kestrel.sources.files import read_csv, read_table, write_features

__all__ = [
    "ACCIDENTS_SCHEMA",
    "ENCODED_ACCIDENTS_SCHEMA",
    "NODE_FEATURES_SCHEMA",
    "read_csv",
    "read_table",
    "write_features",
]
