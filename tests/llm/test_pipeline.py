"""The pipeline against a plain version, stage by stage, and on odd rows."""

import duckdb

import corpus_pipeline
from parcelweave.llm import q_decontaminate, q_mixing, q_quality
from parcelweave.session import cut_lineage
from tests.llm.test_lines import whole_runs
from tests.llm.test_simhash import brute_components, plain_fingerprint

SF = "/root/testdata/sf0.001"


def plain_run(folder):
    """Documents left after each stage, as (doc_id, text, source), and the mix."""
    con = duckdb.connect()
    con.execute(f"create table documents as select * from '{folder}/documents.parquet'")
    con.execute(f"create view benchmark as select * from '{folder}/benchmark.parquet'")
    kept = {r[0] for r in con.execute(f"select doc_id from ({q_quality.SQL}) where kept").fetchall()}
    docs = [r for r in con.execute("select doc_id, text, source from documents order by doc_id").fetchall() if r[0] in kept]
    out = [docs]
    cut = whole_runs([(d, t) for d, t, _ in docs])
    docs = [(d, cut[d], s) for d, _, s in docs]
    out.append(docs)
    tops = brute_components([(d, plain_fingerprint(t)) for d, t, _ in docs])
    docs = [r for r, top in zip(docs, tops, strict=True) if r[0] == top]
    out.append(docs)
    con.execute("create table left_over (doc_id bigint, text varchar, source varchar)")
    con.executemany("insert into left_over values (?, ?, ?)", docs)
    bad = {r[0] for r in con.execute(f"with {q_decontaminate.contaminated_sql('left_over')} select doc_id from decon where contaminated").fetchall()}
    docs = [r for r in docs if r[0] not in bad]
    out.append(docs)
    con.execute(f"delete from left_over where doc_id in ({','.join(map(str, bad)) or 'null'})")
    mix = con.execute(f"select doc_id, size, source_size, target, taken from ({q_mixing.sql('left_over')}) where taken > 0").fetchall()
    return out, mix


def test_stages_equal_plain_version(spark):
    want, mix = plain_run(SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for (name, stage), rows in zip(corpus_pipeline.STAGES[:-1], want, strict=True):
        docs = cut_lineage(stage(spark, docs, SF))
        assert docs.columns == columns, name
        assert sorted((r.doc_id, r.text, r.source) for r in docs.collect()) == sorted(rows), name
        assert all(r.n_chars == len(r.text) for r in docs.collect())
    assert [len(x) for x in want] == sorted((len(x) for x in want), reverse=True) and len(want[2]) < len(want[1])
    last = corpus_pipeline.STAGES[-1][1]
    assert sorted(map(tuple, last(spark, docs, SF).collect())) == sorted(mix)


def odd(spark):
    prose = " ".join(f"word{i} of{i} plain prose{i}" for i in range(60))
    long = "\n".join(f"line{i} of{i} a very{i} long text{i} goes{i}" for i in range(8_000))
    rows = [(1, prose, "en", "a", 5, 1, "k"), (1, prose, "en", "a", 5, 1, "k"), (2, None, "en", "a", None, 1, "k"), (3, "", None, None, 0, None, None), (4, long, "en", None, 9, 2, "k"), (None, prose + " and an end", "en", "a", 5, 3, "k"), (6, "few words", None, "b", 1, 4, "k")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size int, taken string")


def test_odd_rows(spark):
    left = odd(spark)
    columns, none = left.columns, left.limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left, none = cut_lineage(stage(spark, left, SF)), cut_lineage(stage(spark, none, SF))
        assert left.columns == columns == none.columns and none.count() == 0
    assert sorted(r.doc_id or 0 for r in left.collect()) == [1, 4]
    mix = corpus_pipeline.STAGES[-1][1]
    assert mix(spark, none, SF).count() == 0
    assert sum(r.taken for r in mix(spark, left, SF).collect()) > 0


def test_rows_of_one_id_or_none_are_told_apart(spark):
    prose = lambda tag: " ".join(f"{tag}{i} of plain{tag} prose{i * i}" for i in range(80))
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("text").collect()
    dirty = max((r.text for r in items), key=len)
    rows = [(None, prose("a")), (None, prose("b")), (None, prose("b")), (7, prose("c")), (7, prose("d")), (None, prose("c")), (None, dirty), (7, dirty + " x"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    first = cut_lineage(corpus_pipeline.near_dedup(spark, docs, SF))
    apart = {(None, prose("a")), (None, prose("b")), (7, prose("c")), (7, prose("d")), (None, None)}
    assert {tuple(r) for r in first.collect()} - {(None, dirty), (7, dirty + " x")} == apart and first.count() in (6, 7)
    clean = corpus_pipeline.decontamination(spark, docs, SF)
    assert sorted(map(str, clean.collect())) == sorted(str(r) for r in docs.collect() if r.text is None or dirty not in r.text)
