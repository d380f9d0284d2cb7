import hashlib
import re

import pytest
from pyspark.sql import functions as F

from murmur.llm import infill as I


def plain(doc_id, text, rate=100, suffix_first=50, seed="7"):
    """The contract, by a loop over lines."""
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h4 % 100 < suffix_first:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


ODD = [
    "", None, "\n", "\n\n\n", "one", "one\n", "a\nb\nc", "é\n日本\n😀x\n", "a\r\nb\r\n", "\x0b\x0c  y\nz",
    "has <P> in it\nx", "<S>", "a\n<M>\nb", "<\nP>\n<S", "<S", "x<", "<<S\n>>", "P>\n<M", "\x00\n\x00", "a\n" * 3000,
]


@pytest.mark.parametrize("options", [{}, {"rate": 40, "suffix_first": 90, "seed": "x"}])
def test_against_plain(docs, options):
    rows = [{"doc_id": i, "text": t} for i, t in enumerate(ODD * 4)]
    rows += [{"text": "no\nid\n"}, {"doc_id": 5, "text": "again\nand\nagain"}, {"doc_id": 5, "text": "again\nand\nagain"}, {"doc_id": -3, "text": "m\nn"}]
    frame = I.restored_text(I.fill_in_middle(docs(rows), **options))
    got = [tuple(r) for r in frame.collect()]
    want = [(*w, r.get("text") or "") for r in rows for w in [plain(r.get("doc_id"), r.get("text"), **options)]]
    order = lambda r: tuple((x is not None, str(x)) for x in r)
    assert sorted(got, key=order) == sorted(want, key=order)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_digest(docs):
    rows = [{"doc_id": i, "text": f"{i}\nx{i}\n\ny"} for i in range(40)]
    for r in I.infill_digest(docs(rows)).collect():
        want = plain(r.doc_id, rows[r.doc_id]["text"])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == want[1:5]
        assert r.output_sha256 == hashlib.sha256(want[5].encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256(rows[r.doc_id]["text"].encode()).hexdigest()


def test_a_million_lines_and_one_long_line(docs):
    rows = [{"doc_id": 1, "text": "ab\n" * 1_000_000}, {"doc_id": 2, "text": "x" * 5_000_000}]
    got = {r.doc_id: r for r in I.infill_digest(docs(rows)).collect()}
    assert (got[1].n, got[2].n) == (1_000_000, 1)
    for r in rows:
        assert got[r["doc_id"]].restored_sha256 == hashlib.sha256(r["text"].encode()).hexdigest()


def test_one_match_holds_every_unit():
    cut = I.cutter(100, 50, I.SENTINELS)
    n, form, prefix, middle, _ = cut("a\nb\n", "00000001" "00000002" "00000000" "00000063")
    assert (n, form, prefix, middle) == (2, "psm", 2, 2)


def test_empty_and_extra_columns(docs):
    assert I.infill_digest(docs([])).collect() == []
    wide = docs([{"doc_id": 1, "text": "a\nb"}]).withColumns(
        {c: F.lit(None).cast("int") for c in ("digest", "n", "form", "output", "restored", "_parts", "prefix_chars")}
    )
    assert I.infill_digest(wide).collect()[0].restored_sha256 == hashlib.sha256(b"a\nb").hexdigest()
