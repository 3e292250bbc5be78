"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is of bytes folded to 32 classes, one per language, and all of it is counted on Spark:
n-grams are packed in a long, five bits a class and the first uppermost, so shorter n-grams and
contexts are masks and shifts of longer ones.  Counts are tables sharded by (language, n-gram);
joining them with the distinct n-grams of the corpus gives each its probability.  That table has at
most 32^5 rows a language, whatever the size of the corpus, and is handed to the scoring tasks by
languages, as many at a time as fit the bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelweave.llm.common import cut_lineage, prepare

#: Classes of the longest n-gram, and bits of a class.
ORDER, BITS = 5, 5
#: N-grams that scoring tasks hold at a time, 8 bytes each: at least one language's 32^5.
SHARD_ROWS = 1 << (BITS * ORDER)
#: Distinct n-grams that a counting task gathers before it hands them on.
GATHER_ROWS = 2_000_000
#: Bytes of text whose n-grams are in memory at a time, but for a single longer text.
RUN_BYTES = 1_500_000
#: Bytes over which the peak of a document is averaged: about a word.
PEAK = 6
#: A document is kept up to this quantile of its language's trusted documents, times the slack.
QUANTILE, SLACK = 0.99, 1.1


def classes() -> np.ndarray:
    """Class of each byte: white space 0, letters 1 to 26 whatever their case, digits 27, marks of
    prose 28, other ASCII 29, even and odd bytes beyond ASCII 30 and 31."""
    fold = np.full(256, 29, dtype=np.int64)
    fold[[9, 10, 11, 12, 13, 32]] = 0
    for i in range(26):
        fold[[65 + i, 97 + i]] = 1 + i
    fold[48:58] = 27
    fold[list(b".,;:!?'\"()-")] = 28
    fold[128:] = 30 + np.arange(128) % 2
    return fold


_FOLD = classes()


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram ending at each byte of each text, and the text's number; texts begin as after white space."""
    pad = b" " * (ORDER - 1)
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    data = _FOLD[np.frombuffer(pad + pad.join(texts), dtype=np.uint8)]
    n = len(data) - ORDER + 1
    codes = np.zeros(max(n, 0), dtype=np.int64)
    for i in range(ORDER):
        codes = codes << BITS | data[i : i + n] if n > 0 else codes
    owner = np.repeat(np.arange(len(texts)), lengths)
    # Text k begins behind k + 1 pads; the n-gram ending at its first byte begins with its pad.
    starts = np.cumsum(np.concatenate([[0], lengths[:-1]])) + np.arange(len(texts)) * (ORDER - 1)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(starts, lengths)
    return codes[at], owner


def _batches(batch, first: int) -> Iterator[tuple[str, np.ndarray, list[bytes]]]:
    """Per language: its name, the row numbers, the texts; in runs of bounded size."""
    import pyarrow as pa

    langs = np.array(batch.column(first).to_pylist(), dtype=object)
    texts = batch.column(first + 1).cast(pa.binary())
    for lang in sorted(set(langs)):
        rows, part, size = [], [], 0
        for i in np.nonzero(langs == lang)[0]:
            text = texts[int(i)].as_py() or b""
            rows.append(int(i))
            part.append(text)
            size += len(text)
            if size > RUN_BYTES:
                yield lang, np.array(rows), part
                rows, part, size = [], [], 0
        if rows:
            yield lang, np.array(rows), part


def _counts(batches: Iterator) -> Iterator:
    import pyarrow as pa

    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def packed():
        for lang, (codes, counts) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(counts)], ["lang", "gram", "n"])
        held.clear()

    for batch in batches:
        for lang, _, texts in _batches(batch, 0):
            codes, counts = np.unique(grams(texts)[0], return_counts=True)
            if lang in held:
                codes, place = np.unique(np.concatenate([held[lang][0], codes]), return_inverse=True)
                counts = np.bincount(place, weights=np.concatenate([held[lang][1], counts])).astype(np.int64)
            held[lang] = codes, counts.astype(np.int64)
        if sum(len(c) for c, _ in held.values()) > GATHER_ROWS:
            yield from packed()
    yield from packed()


def gram_counts(texts: DataFrame) -> DataFrame:
    """``lang, gram, n`` of a table of ``lang, text``."""
    prepare(texts.sparkSession)
    parts = texts.select("lang", "text").mapInArrow(_counts, "lang string, gram long, n long")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(texts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """Tables of orders 1 to ``ORDER``: ``lang, gram, top`` (the discounted share of the n-gram in its
    context) and, once per context, ``lang, context, back`` (the weight of the lower order).

    The longest order counts occurrences, shorter ones the bytes that stand before.  Discounts of an
    order and language follow from how many n-grams have counts 1 to 4.
    """
    counts = cut_lineage(gram_counts(texts))
    tables = []
    for order in range(ORDER, 0, -1):
        context = F.shiftrightunsigned("gram", BITS) if order > 1 else F.lit(0).cast("long")
        have = [F.count_if(F.col("n") == k).alias(f"n{k}") for k in (1, 2, 3, 4)]
        seen = counts.groupBy("lang").agg(*have)
        y = F.when(F.col("n1") + 2 * F.col("n2") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(0.5)

        def discount(k: int, y: Column = y) -> Column:
            raw = F.when(F.col(f"n{k}") > 0, k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}"))
            # Where a count of counts is missing, or noise turns the estimate, a plain half of the count.
            return F.when(raw.between(0.05 * k, 0.95 * k), raw).otherwise(0.5 * k).alias(f"d{k}")

        seen = cut_lineage(seen.select("lang", discount(1), discount(2), discount(3)))
        own = counts.withColumn("context", context).join(seen, "lang")
        off = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        sums = own.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.sum(off).alias("off"))
        sums = cut_lineage(sums)
        tops = own.join(sums.select("lang", "context", "total"), ["lang", "context"])
        tops = cut_lineage(tops.select("lang", "gram", ((F.col("n") - off) / F.col("total")).alias("top")))
        tables.append((tops, sums.select("lang", "context", (F.col("off") / F.col("total")).alias("back"))))
        if order > 1:
            mask = F.lit((1 << BITS * (order - 1)) - 1)
            counts = cut_lineage(counts.groupBy("lang", F.col("gram").bitwiseAND(mask).alias("gram")).agg(F.count("*").alias("n")))
    return tables[::-1]


def probabilities(tables: list[tuple[DataFrame, DataFrame]], wanted: DataFrame) -> DataFrame:
    """``lang, gram, logp`` of the wanted (lang, gram): joins with the count tables from the shortest order
    up, each distinct shorter n-gram being looked up once.  A byte unseen by all orders gets 1/32 of what is left."""
    levels = [wanted]
    for order in range(ORDER - 1, 0, -1):
        mask = F.lit((1 << BITS * order) - 1)
        levels.insert(0, levels[0].select("lang", F.col("gram").bitwiseAND(mask).alias("gram")).distinct())
    below = None
    for order, (tops, backs) in enumerate(tables, start=1):
        context = F.shiftrightunsigned("gram", BITS) if order > 1 else F.lit(0).cast("long")
        rows = levels[order - 1].withColumn("context", context).join(tops, ["lang", "gram"], "left").join(backs, ["lang", "context"], "left")
        if below is None:
            lower = F.lit(1 / 32)
        else:
            rows = rows.withColumn("low", F.col("gram").bitwiseAND(F.lit((1 << BITS * (order - 1)) - 1))).join(below, ["lang", "low"])
            lower = F.col("lower")
        p = F.when(F.col("back").isNull(), lower).otherwise(F.coalesce("top", F.lit(0.0)) + F.col("back") * lower)
        done = cut_lineage(rows.select("lang", "gram", p.alias("p")))
        below = done.select("lang", F.col("gram").alias("low"), F.col("p").alias("lower"))
    return done.select("lang", "gram", F.log("p").alias("logp"))


def _scorer(shared):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        tables = shared.value
        for batch in batches:
            total, peak = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            size = np.zeros(batch.num_rows, dtype=np.int64)
            for lang, rows, texts in _batches(batch, 1):
                codes, owner = grams(texts)
                size[rows] = np.bincount(owner, minlength=len(texts))
                if not len(codes):
                    continue
                known, logp = tables[lang]
                cost = -logp[np.searchsorted(known, codes)].astype(np.float64)
                total[rows] = np.bincount(owner, weights=cost, minlength=len(texts))
                run = np.concatenate([[0.0], np.cumsum(cost)])
                mean = (run[PEAK:] - run[:-PEAK]) / PEAK
                inside = owner[PEAK - 1 :] == owner[: max(0, len(owner) - PEAK + 1)]
                best = np.zeros(len(texts))
                np.maximum.at(best, owner[PEAK - 1 :][inside], mean[inside])
                peak[rows] = best
            columns = [batch.column(0), batch.column(1), pa.array(size), pa.array(total), pa.array(peak)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang", "n_bytes", "cost", "peak"])

    return run


def _language_groups(logp: DataFrame) -> Iterator[list[str]]:
    """Languages in groups of at most ``SHARD_ROWS`` n-grams in all."""
    group, size = [], 0
    for row in logp.groupBy("lang").count().orderBy("lang").toLocalIterator():
        if group and size + row["count"] > SHARD_ROWS:
            yield group
            group, size = [], 0
        group.append(row.lang)
        size += row["count"]
    if group:
        yield group


def _packed(rows):
    """One language's n-grams of one range as two blobs."""
    import pyarrow as pa

    rows = rows.sort_by("gram")
    codes = rows.column("gram").to_numpy().astype(np.int32)
    logs = rows.column("logp").to_numpy().astype(np.float32)
    return pa.table({"lang": [rows.column("lang")[0].as_py()], "first": [int(codes[0])], "codes": [codes.tobytes()], "logs": [logs.tobytes()]})


def perplexities(docs: DataFrame, tables: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``doc_id, lang, n_bytes, perplexity, peak`` of a table of ``doc_id, lang, text``.

    The peak is the largest mean cost of ``PEAK`` bytes in a row, so that a few foreign words show in a
    long text.  A text without bytes has a null perplexity and no peak.
    """
    spark = prepare(docs.sparkSession)
    wanted = cut_lineage(gram_counts(docs).select("lang", "gram"))
    logp = cut_lineage(probabilities(tables, wanted))
    blobs = logp.groupBy("lang", F.shiftright("gram", 20).alias("range")).applyInArrow(lambda rows: _packed(rows), "lang string, first long, codes binary, logs binary")
    blobs = cut_lineage(blobs)
    scored = None
    for group in _language_groups(logp):
        held: dict[str, list] = {}
        for row in blobs.filter(F.col("lang").isin(group)).orderBy("lang", "first").toLocalIterator():
            held.setdefault(row.lang, []).append((np.frombuffer(row.codes, np.int32), np.frombuffer(row.logs, np.float32)))
        shard = {lang: tuple(np.concatenate(x) for x in zip(*parts, strict=True)) for lang, parts in held.items()}
        part = docs.filter(F.col("lang").isin(group)).select("doc_id", "lang", "text")
        part = part.mapInArrow(_scorer(spark.sparkContext.broadcast(shard)), "doc_id long, lang string, n_bytes long, cost double, peak double")
        scored = part if scored is None else scored.unionByName(part)
    bare = docs.join(logp.select("lang").distinct(), "lang", "left_anti")  # languages without a single byte
    bare = bare.select("doc_id", "lang", F.lit(0).cast("long").alias("n_bytes"), F.lit(0.0).alias("cost"), F.lit(0.0).alias("peak"))
    scored = bare if scored is None else scored.unionByName(bare)
    each = F.when(F.col("n_bytes") > 0, F.exp(F.col("cost") / F.col("n_bytes")))
    return scored.select("doc_id", "lang", "n_bytes", each.alias("perplexity"), "peak")


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per document: doc_id, lang, n_bytes, perplexity, peak, kept.

    Trusted are documents all of whose labels say quality 1 and toxic 0; the model counts every one of
    them.  A document is kept if neither its perplexity nor its peak passes the ``QUANTILE`` of the
    trusted documents of its language by more than the ``SLACK``.

    Null and empty texts are not kept; null languages form one language, returned as empty; languages
    without trusted documents have no threshold, so what has any bytes is kept; null ids are never
    trusted; repeated rows are scored alike and, if trusted, counted each; texts of any length are read
    whole; an empty table gives no rows, and without labels all that has bytes is kept.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"), F.col(text).alias("text"))
    trusted = labels.groupBy("doc_id").agg(F.min(F.coalesce("quality", F.lit(0))).alias("q"), F.max(F.coalesce("toxic", F.lit(1))).alias("t"))
    trusted = cut_lineage(trusted.filter("q = 1 and t = 0 and doc_id is not null").select("doc_id"))
    # Trusted ids grow with the corpus, so they are never broadcast.
    tables = train(rows.join(trusted.hint("merge"), "doc_id"))
    scored = cut_lineage(perplexities(rows, tables))
    limits = scored.join(trusted, "doc_id").groupBy("lang").agg(
        (SLACK * F.percentile_approx("perplexity", QUANTILE, 100_000)).alias("most"), (SLACK * F.percentile_approx("peak", QUANTILE, 100_000)).alias("top")
    )
    judged = scored.join(cut_lineage(limits), "lang", "left")
    within = (F.col("perplexity") <= F.col("most")) & (F.col("peak") <= F.col("top"))
    kept = (F.col("n_bytes") > 0) & F.coalesce(within, F.lit(True))
    return judged.select("doc_id", "lang", "n_bytes", "perplexity", "peak", kept.alias("kept"))
