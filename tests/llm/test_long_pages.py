"""Pages of any size and depth of nesting are cut in time that grows with their length."""

import random
import re
import time

import pytest

from kestrel.llm import html_extract
from kestrel.llm.html_blocks import INLINE, VOID, blocks


def simple_blocks(page):
    """Brute force for pages whose tags all close in order: the text between two block-level tags."""
    out, open_, text = [], [], ""
    for tag, body in re.findall(r"<([^>]*)>|([^<]+)", page) + [("/end", "")]:
        if body:
            text += body
            continue
        name = tag.strip("/")
        if name in INLINE:
            continue
        if " ".join(text.split()):
            out.append((" ".join(text.split()), set(open_)))
        text = ""
        if tag.startswith("/"):
            open_ = open_[:-1]
        elif name not in VOID:
            open_.append(name)
    return out


@pytest.mark.parametrize("seed", range(20))
def test_blocks_of_well_formed_pages_equal_brute_force(seed):
    rng = random.Random(seed)

    def node(depth):
        if depth == 0 or rng.random() < 0.3:
            return " ".join(rng.choice(["one", "two", "three"]) for _ in range(rng.randint(1, 4)))
        tag = rng.choice(["div", "section", "article", "b", "span", "blockquote"])
        return f"<{tag}>" + " ".join(node(depth - 1) for _ in range(rng.randint(1, 4))) + f"</{tag}>"

    page = "".join(f"<div>{node(5)}</div>" for _ in range(5))
    # block elements inside inline ones are not in the brute force's reach
    if not re.search(r"<(b|span)>(?:(?!</\1>).)*<(div|section|article|blockquote)", page):
        got = [(b.text, {t for t in b.path if t not in INLINE}) for b in blocks(page)]
        assert got == simple_blocks(page)


@pytest.mark.parametrize(
    "page",
    ["<div>x" * 50_000, "<div>" * 20_000 + "</section>x" * 20_000, "<b>" * 20_000 + "</p>x" * 20_000, "<p>some words of text</p>" * 200_000],
)
def test_deep_and_long_pages_take_linear_time(page):
    start = time.process_time()
    found = blocks(page)
    assert time.process_time() - start < 20 and len(found) >= 20_000
    assert max(len(b.path) for b in found) < 6


def test_long_pages_are_extracted_whole(spark, tmp_path):
    words = " ".join(f"word{i}" for i in range(60))
    pages = [(i, f"u{i}", f"<html><body><nav><a href=x>menu</a></nav><article><p>{words} {i}</p><p>{words}</p></article></body></html>") for i in range(30)]
    long_text = "".join(f"<p>{words} {k}</p>" for k in range(9_000))
    pages += [(90, "long", f"<html><body><article>{long_text}</article></body></html>"), (91, "deep", "<div>" * 50_000 + "x"), (92, None, None)]
    path = str(tmp_path / "p.parquet")
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(path)
    rows = {r["page_id"]: r for r in html_extract.extract(spark.read.parquet(path)).collect()}
    assert len(rows) == 33 and rows[90]["n_blocks"] == 9_000 and rows[91]["n_blocks"] == 1 and rows[92]["text"] == ""
    assert all(r["n_chars"] == len(r["text"]) for r in rows.values())
