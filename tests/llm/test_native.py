"""Quality rules, chat format, mix, archive and decontamination: odd rows and round trips."""

import time
import uuid

import pytest
from pyspark.sql import functions as F

from parcelweave.llm import chat, decontaminate, mixing, quality, warc
from parcelweave.session import scratch_path


def test_quality_odd_rows(spark):
    prose = " ".join(f"w{i}" for i in range(40))
    rows = [(1, prose, 1, "x"), (1, prose, 1, "x"), (2, None, 1, "x"), (3, "", None, None), (None, prose, 1, "x"), (4, prose * 2000, 1, "x"), (5, "a b c d e f g h " * 30, 1, "x"), (6, "# " * 40 + prose, 1, "x"), (7, prose + " ####" * 7, 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, kept string")
    got = {(r.doc_id, r.base_failed, r.kept, r.n_repeat_words) for r in quality.measure(docs).collect()}
    assert {(1, False, True, 0), (None, False, True, 0), (2, True, False, 0), (3, True, False, 0), (5, True, False, 240)} <= got
    assert (6, True, False, 40) in got and (7, False, False, 0) in got
    judged = quality.apply_rules(docs)
    assert judged.columns == [*docs.columns, "rejected_by"] and judged.count() == 9
    assert quality.keep_good(docs).columns == docs.columns
    assert quality.measure(docs.limit(0)).count() == 0


def test_cascade_order():
    estimates = [quality.Estimate(r.name, 1.0 + i, 0.1 if r.name != "repeats" else 0.9) for i, r in enumerate(quality.RULES)]
    order = [r.name for r in quality.cascade(estimates)]
    assert order[0] == "repeats" and order[1:] == [r.name for r in quality.RULES[:-1]]


def test_chat_round_trip(spark):
    nasty = ["<turn>", "\\l", "\\\\l<", "a<text>b", "</turn>\n<turn>x", "<next>", "\\", "\\\\", "", None, "<tur", "l\\<next>", "\n", "ü<\\l>"]
    rows = [(1, i, r, t) for i, (r, t) in enumerate((r, t) for t in nasty for r in ("user", "assistant", "assistant"))]
    rows += [(2, 0, None, "x"), (2, 0, "assistant", "y"), (2, None, "a<text>", "z"), (None, 1, "assistant", "n"), (3, 1, "user", "u" * 300_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    out = chat.format_chats(df)
    back = {r.conv_id: r for r in out.select("conv_id", chat.read_turns(F.col("formatted")).alias("t"), chat.learnt_text(F.col("formatted"), F.col("loss_spans")).alias("l")).collect()}
    assert [tuple(t) for t in back[1].t] == [(r, t or "") for _, _, r, t in rows[: 3 * len(nasty)]]
    assert back[1].l == "".join((t or "") * 2 for t in nasty)
    assert [tuple(t) for t in back[2].t] == [("a<text>", "z"), ("", "x"), ("assistant", "y")]
    assert back[None].l == "n" and back[3].l == "" and len(back[3].t[0].text) == 300_000
    formatted = out.filter("conv_id = 1").first().formatted
    assert formatted.count("<turn>") == 2 * len(nasty)  # adjacent turns of one role are one block
    assert chat.format_chats(df.limit(0)).count() == 0


def test_long_conversation_takes_linear_time(spark):
    turns = spark.range(39_999).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("<turn>t"), "id").alias("text"))
    began = time.monotonic()
    row = chat.format_chats(turns).select("loss_spans", chat.learnt_text(F.col("formatted"), F.slice("loss_spans", 1, 3)).alias("first"), F.length("formatted").alias("n")).first()
    assert time.monotonic() - began < 20
    spans = [(s.start, s.length) for s in row.loss_spans]
    assert len(spans) == sum(i % 3 != 0 for i in range(39_999)) and row.first == "<turn>t1<turn>t2<turn>t4"
    assert all(a + n < b for (a, n), (b, _) in zip(spans, spans[1:], strict=False)) and sum(spans[-1]) + len("</turn>\n") == row.n + 1


def test_mix_odd_rows(spark):
    rows = [(1, "a b c", "s", 7), (1, "a b c", "s", 7), (2, None, "s", None), (3, "", None, 7), (4, "x " * 100_000, "big", 7), (None, "p q", None, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = mixing.mix(docs).collect()
    assert len(got) == 6 and all(0 <= r.taken <= 3 * r.size for r in got)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(5)).collect()))
    assert {r.target for r in got if r.size == 3} == {18.0}
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mix(docs.filter("text = ''")).first().target == 0.0


def test_mix_comes_near_its_targets(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 50 + 1).cast("int")).alias("text"), F.concat(F.lit("s"), F.col("id") % 4).alias("source"))
    rows = mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.sum("taken").alias("n"), F.first("target").alias("t"), F.first("source_size").alias("s")).collect()
    assert all(abs(r.n - r.t) <= 25 and r.t <= 3 * r.s for r in rows)
    assert abs(sum(r.t for r in rows) - sum(r.s for r in rows)) < 1e-6


def pages(spark):
    body = "<p>" + "long enough to be revisited " * 6
    rows = [(5, "u5", body), (3, "u3", body), (3, "u3", body), (9, None, body), (None, "un", body), (1, "a\r\nb: c", "short"), (2, "u", "short"), (4, "u", None), (7, "u", ""), (8, "ü", "é" * 99), (6, "u", "WARC/1.1\r\n\r\n" * 30_000)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))


def test_archive_odd_rows(spark):
    path = scratch_path(spark, f"t-archive-{uuid.uuid4().hex}")
    warc.write_archive(pages(spark), path)
    rows = warc.read_archive(spark, path).collect()
    got = sorted((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in rows)
    n = len("<p>") + 28 * 6
    assert got == [(0, "revisit", 3, n), (1, "response", None, 5), (2, "response", None, 5), (3, "response", None, n), (3, "response", None, n), (4, "response", None, 0), (5, "revisit", 3, n), (6, "response", None, 360_000), (7, "response", None, 0), (8, "response", None, 198), (9, "revisit", 3, n)]
    assert {r.page_id: r.url for r in rows}[1] == "a%0D%0Ab: c"
    assert spark.read.parquet(f"{path}/payloads").count() == 5
    out = scratch_path(spark, f"t-warc-{uuid.uuid4().hex}")
    warc.export_warc(spark, path, out)
    want = sorted((r.header, b"" if "WARC-Type: revisit" in r.header else bytes(r.payload)) for r in warc.restore(spark, path).collect())
    assert sorted((r.header, bytes(r.payload)) for r in warc.import_warc(spark, out).collect()) == want
    none = scratch_path(spark, f"t-none-{uuid.uuid4().hex}")
    warc.write_archive(pages(spark).limit(0), none)
    assert warc.read_archive(spark, none).count() == 0


def test_archive_finds_damage(spark):
    path = scratch_path(spark, f"t-damage-{uuid.uuid4().hex}")
    warc.write_archive(pages(spark), f"{path}/good")
    spark.read.parquet(f"{path}/good/payloads").withColumn("payload", F.concat("payload", F.lit(b"x"))).write.parquet(f"{path}/bad/payloads")
    spark.read.parquet(f"{path}/good/headers").write.parquet(f"{path}/bad/headers")
    with pytest.raises(Exception, match="does not match"):
        warc.read_archive(spark, f"{path}/bad").collect()


def items(spark):
    long = " ".join(f"i{k}" for k in range(20))
    return spark.createDataFrame([(1, long), (2, "Short item here"), (2, "other words"), (3, None), (4, "!!"), (None, "nameless one"), (10, long)], "item_id long, text string")


def docs_for(spark):
    hit = " ".join(f"I{k}" for k in range(2, 16))
    rows = [(1, "before " + hit + " after", 1), (2, None, 1), (3, "", 1), (4, "short-item, HERE! and other words", None), (5, "nothing of that", 1), (5, "nothing of that", 1), (None, "nameless one", 1), (6, "filler " * 200_000 + hit, 1), (7, "i0 i1 i2 i3 i4 i5 i6 i7 i8 i9 i10 i11", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, items int")


@pytest.mark.parametrize("block", [500_000, 2])
def test_contamination_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    rows = decontaminate.judged(decontaminate.contamination(docs_for(spark), items(spark))).collect()
    got = sorted((r.doc_id or 0, r.n_words, r.n_hit, r["items"], r.contaminated) for r in rows)
    assert got == [(0, 2, 2, ["null"], True), (1, 16, 14, ["1", "10"], True), (2, 0, 0, [], False), (3, 0, 0, [], False), (4, 6, 5, ["2"], True), (5, 3, 0, [], False), (5, 3, 0, [], False), (6, 200_014, 14, ["1", "10"], False), (7, 12, 0, [], False)]
    docs = docs_for(spark)
    assert decontaminate.keep_clean(docs, items(spark)).columns == docs.columns
    assert decontaminate.contamination(docs.limit(0), items(spark)).count() == 0
    assert decontaminate.keep_clean(docs, items(spark).limit(0)).count() == 9


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x x beta x alpha"), (2, "beta alpha"), (3, "alpha"), (4, "beta x x x x alpha")], "doc_id long, text string")
    got = sorted(map(tuple, decontaminate.proximity_matches(docs, {"q": ["alpha", "Beta"], "none": ["gone"]}, within=2).collect()))
    assert got == [(1, "q", 3), (2, "q", 0)]
