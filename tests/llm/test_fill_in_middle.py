"""Fill in the middle: against plain slicing, and back again."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from statement_lake.llm import fill_in_middle as fim

TEXTS = st.text(st.sampled_from("ab é🎉\n<PSM>"), max_size=60)


def plain(doc, text, seed=7, rate=100, spm=50):
    """The contract by slices of a list of lines."""
    lines = re.findall("[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(lines), "plain", None, None, text
    a, b = sorted((h[0] % (len(lines) + 1), h[1] % (len(lines) + 1)))
    prefix, middle, suffix = ("".join(lines[i:j]) for i, j in ((0, a), (a, b), (b, None)))
    if h[3] % 100 < spm:
        return len(lines), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(lines), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@settings(max_examples=500, deadline=None)
@given(st.integers(-5, 10**15), TEXTS)
def test_equals_slicing_and_inverts(doc, text):
    found = fim._described(doc, text.encode(), 7, 100, 50)
    n, form, prefix, middle, output = plain(doc, text)
    assert found[1:] == (n, form, prefix, middle, bytearray(output.encode()))
    assert fim.invert(output.encode(), form) == text.encode()


@given(st.binary(max_size=30), st.integers(0, 30), st.integers(0, 30))
def test_a_rotation_exchanges_neighbours(data, a, b):
    start, cut = sorted((min(a, len(data)), min(b, len(data))))
    buffer = bytearray(data)
    fim.rotate(buffer, start, cut, len(data))
    assert buffer == data[:start] + data[cut:] + data[start:cut]


def test_rows_of_every_kind(spark):
    rows = [
        (1, "a\nb\nc"), (2, None), (3, ""), (None, "x\ny\n"), (None, None), (5, "with <S> in it\nand more"),
        (6, "\n\n\n"), (7, "no line feed"), (7, "no line feed"), (7, "other\nlines"), (8, "é🎉\n" * 50_000),
        (9, "ends with <S\n>P>\n"),
    ]
    frame = spark.createDataFrame([(d, t, "kept out", "1") for d, t in rows], "doc_id long, text string, form string, output string")
    for rate, spm in ((100, 50), (40, 100), (0, 50)):
        cut = fim.fill_in_middle(frame, rate=rate, spm_share=spm)
        found = fim.restore(cut).collect()
        wanted = [(d, *plain(d, t or "", 7, rate, spm), t or "") for d, t in rows]
        assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)
    again = fim.restore(fim.restore(cut)).columns
    assert again == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]


def test_no_rows(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert fim.restore(fim.fill_in_middle(frame)).count() == 0
