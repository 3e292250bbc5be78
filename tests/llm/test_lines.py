"""Line deduplication against a plain version."""

import hashlib
import random

import duckdb

from parcelweave.llm import q_lines
from parcelweave.llm.lines import chunk_ends, chunks, dedup_lines

SF = "/root/testdata/sf0.01"


def whole_runs(rows):
    """Texts of (id, text) less all lines in a run of two lines with words and eight words at least that
    an earlier place holds and does not overlap, by trying every run."""
    first, out = {}, {}
    for doc, text in sorted(rows):
        lines, gone = text.split("\n"), set()
        counts = [len(x.encode().split()) for x in lines]
        for a in range(len(lines)):
            for b in range(a + 2, len(lines) + 1):
                part = counts[a:b]
                if part[0] and part[-1] and sum(c > 0 for c in part) >= 2 and sum(part) >= 8:
                    before = first.setdefault("\n".join(lines[a:b]), (doc, a, b))
                    if before[0] != doc or a >= before[2]:
                        gone |= set(range(a, b))
        out[doc] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


def test_query_equals_plain_version(spark):
    rows = duckdb.connect().execute(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    want = {(d, len(t), hashlib.sha256(t.encode()).hexdigest()) for d, t in whole_runs(rows).items()}
    got = {(r.doc_id, r.n_chars_left, r.text_sha256) for r in q_lines.query(spark, SF).collect()}
    assert got == want
    assert sum(len(t) for _, t in rows) > sum(n for _, n, _ in want)


def passage(tag, n=12):
    return "\n".join(f"{tag} line {i} of several words here" for i in range(n))


def test_shifted_passage_is_cut_once(spark):
    shared = passage("shared", 40)
    docs = spark.createDataFrame([(1, passage("a") + "\n" + shared), (2, passage("b", 5) + "\n" + shared + "\n" + passage("c"))], "doc_id long, text string")
    got = {r.doc_id: r.text for r in dedup_lines(docs).collect()}
    assert got[1] == passage("a") + "\n" + shared
    assert got[2].count("shared") < 14 and passage("b", 3) in got[2]


def test_odd_rows(spark):
    p = passage("x")
    long = "\n".join(f"unique {i} words in this line" for i in range(20_000))
    data = [(None, p, 1, "k"), (1, None, 1, None), (2, "", 1, "k"), (3, p, None, "k"), (3, p, None, "k"), (4, long, 1, "k"), (5, p, 1, "k")]
    docs = spark.createDataFrame(data, "doc_id long, text string, first int, key string")
    out = dedup_lines(docs)
    assert out.columns == docs.columns and out.count() == 7
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, set()).add(r.text)
    assert got[1] == {None} and got[2] == {""} and got[4] == {long} and got[3] == {p}
    assert all(len(t) < len(p) for t in got[None] | got[5])


def test_empty(spark):
    assert dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_every_repeated_run_is_cut_to_its_ends(spark):
    rows = duckdb.connect().execute(f"select doc_id, text from '{SF}/documents.parquet' where length(text) < 20000").fetchall()
    pair = "one line of five words\nand a second of them"
    tiny = "a b\n\nc d\ne\nf g h"
    rows += [(10**7 + i, t) for i, t in enumerate([f"x\n{pair}\ny", f"{pair}\nz z", f"p\nq\n{pair}", f"{tiny}\nend", f"start\n{tiny}", "\n".join(["same words on a line"] * 5), "u u u u v\nu u u u v\nu u u u v"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in dedup_lines(docs).collect()}
    assert got == whole_runs(rows)
    assert [got[10**7 + i] for i in (1, 2, 4)] == ["z z", "p\nq", "start"]


def test_chunks_are_shift_resistant_and_cover_long_passages():
    shared = [f"shared line {i} of several words here".encode() for i in range(60)]
    places = []
    for before in (0, 3, 17):
        lines = [f"other line {i} before it".encode() for i in range(before)] + shared + [b"an end of its own"]
        ends = chunk_ends(lines)
        assert ends[-1] == len(lines) and ends == sorted(set(ends))
        places.append({tuple(lines[a:b]) for a, b, _ in chunks(lines)})
    assert sum(len(c) for c in places[0] & places[1] & places[2]) >= 40


def test_runs_inside_and_across_removed_chunks(spark):
    """Texts that hold a whole passage, its middle, and its edges, each next to other lines."""
    shared = [f"shared line {i} of several words" for i in range(30)]
    rows = [(1, "\n".join(["a b c", *shared, "d e f"])), (2, "\n".join(["g h", *shared, "i j"])), (3, "\n".join(["k l", *shared[10:14], "m n"])), (4, "\n".join([*shared[28:], "o p", *shared[:2]])), (5, "\n".join([*shared[5:25], *shared[5:25]]))]
    rows += [(6, "\n".join(["q r s t", "u v w x y", *shared[:9]])), (7, "\n".join(["q r s t", "u v w x y", "\t", *shared[20:]]))]
    got = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == whole_runs(rows)
    assert got[2] == "g h\ni j" and got[3] == "k l\nm n" and got[5] == ""


def test_periodic_and_random_texts(spark):
    rng = random.Random(5)
    words = ["one two three four", "five six seven eight nine", "ten eleven", "", "twelve thirteen fourteen"]
    rows = [(i, "\n".join(rng.choices(words[: 2 + i % 4], k=rng.randrange(1, 14)))) for i in range(120)]
    rows += [(200, "\n".join(["same line of five words"] * 9)), (201, "\n".join(["same line of five words"] * 5)), (202, "\n".join(words * 3))]
    got = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == whole_runs(rows)
