"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

An item's windows are sets of word shingles, and a document contains a window when it holds all of them, in
place.  So one shingle of a window is a necessary prefix, and the rarest is the cheapest.  Documents meet the
benchmark's shingles once, which also counts how rare each is; only places of a window's rarest shingle are then
candidates, kept if the window fits into the document around them, and compared word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreflow.llm.joins import checked
from oreflow.sources.scratch import written

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_MARK = "every document"


def words(text: Column) -> Column:
    """Runs of ASCII letters, digits and non-ASCII characters, A-Z in lower case; a null has none."""
    ascii_only = F.length(text) == F.octet_length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))
    return F.array_remove(F.split(F.coalesce(low, F.lit("")), _SEPARATOR), "")


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """``item_id``, ``win`` (its words, spaced) and ``win_words``: every run of ``window`` words, or a shorter item whole."""
    split = items.select("item_id", words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    runs = split.select("item_id", "w", F.explode(starts).alias("at"))
    runs = runs.select("item_id", F.slice("w", F.col("at") + 1, window).alias("win_words"))
    return runs.select("item_id", F.array_join("win_words", " ").alias("win"), "win_words").distinct()


def window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """A row for each shingle of each distinct window: ``off`` its place, ``k`` its words, ``gram`` their text."""
    distinct = windows.select("win", F.size("win_words").alias("win_len"), "win_words").dropDuplicates(["win"])
    k = F.least(F.lit(shingle), F.col("win_len"))
    placed = distinct.select("*", k.alias("k"), F.explode(F.sequence(F.lit(0), F.col("win_len") - k)).alias("off"))
    return placed.select("win", "win_len", "k", "off", F.slice("win_words", F.col("off") + 1, F.col("k")).alias("g"))


def _run_hash(array: str, at: Column, k: int) -> Column:
    return F.xxhash64(*[F.get(F.col(array), at + i) for i in range(k)])


def _run_hashes(array: str, k: int) -> Column:
    return F.transform(array, lambda _, at: _run_hash(array, at, k))


def _meet(docs: DataFrame, ids: list[str], grams: DataFrame, lengths: list[int], window: int, broadcast_rows: int) -> DataFrame:
    """Every place where a document holds one of the shingles, with the words around it, and a row for each document.

    If the shingles are few enough they are broadcast, and documents are read in one pass.  Else only the hashes of
    documents' shingles are shuffled, and documents with a hit join their hits again by row.
    """
    split = docs.select(F.monotonically_increasing_id().alias("row"), *ids, words(F.col("text")).alias("w"))
    split = split.withColumn("n", F.size("w"))
    runs = [_run_hashes("w", k) for k in lengths]
    known = grams.select("k", F.array_join("g", " ").alias("gram"), "g").distinct()
    hashed = known.withColumn("h", F.coalesce(*[F.when(F.col("k") == k, _run_hash("g", F.lit(0), k)) for k in lengths], F.lit(0)))
    dictionary = written(hashed.select("k", "gram", "h"), "decontam-shingles")
    # Place p lists the runs of one length after those of another.
    at = F.when(F.col("n") > 0, F.col("p") % F.col("n")).otherwise(0)
    length = F.when(F.col("n") > 0, F.get(F.array(*[F.lit(k) for k in lengths]), F.expr("p div n").cast("int")))
    same = (length == F.col("k")) & (F.array_join(F.slice("w", at + 1, F.col("k")), " ") == F.col("gram"))
    low = F.greatest(at - (window - F.col("k")), F.lit(0))
    near = F.when(F.col("gram").isNotNull(), F.slice("w", low + 1, at + window - low))
    found = ["row", *ids, "n", "gram", at.alias("at"), low.alias("low"), near.alias("near")]

    if dictionary.count() <= broadcast_rows:
        mark = F.xxhash64(F.lit(_MARK))
        lone = docs.sparkSession.range(1).select(F.lit(0).alias("k"), F.lit(None).cast("string").alias("gram"), mark.alias("h"))
        laid = split.select("row", *ids, "n", "w", F.posexplode(F.concat(*runs, F.array(mark))).alias("p", "h"))
        is_mark = F.col("gram").isNull() & (F.col("p") == F.col("n") * len(lengths))
        return laid.join(F.broadcast(dictionary.unionByName(lone)), "h").filter(is_mark | same).select(*found)

    split = written(split, "decontam-words")
    hits = split.select("row", F.posexplode(F.concat(*runs)).alias("p", "h")).join(dictionary, "h").drop("h")
    places = hits.join(split, "row").filter(same).select(*found)
    return places.unionByName(split.select("row", *ids, "n"), allowMissingColumns=True)


def _covered(occurrences: DataFrame) -> DataFrame:
    """Words inside any occurrence: the length of the union of a document's intervals."""
    before = Window.partitionBy("row").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    spans = occurrences.select("row", "start", (F.col("start") + F.col("win_len")).alias("stop")).distinct()
    reached = spans.withColumn("reached", F.coalesce(F.max("stop").over(before), F.lit(0)))
    gain = F.greatest(F.col("stop") - F.greatest("start", "reached"), F.lit(0))
    return reached.groupBy("row").agg(F.sum(gain).alias("n_hit"))


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = 13,
    shingle: int = 5,
    per_hit: int = 20,
    broadcast_rows: int = 1_000_000,
    ids: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """Per row of ``docs``: its ``ids``, ``n_words, n_hit, n_items, items_sha256, contaminated``.

    A word is hit when it lies in an occurrence of a window of an item; a document is contaminated when it has a
    hit word and at least one word in ``per_hit`` is hit.  Null or wordless texts have no words and are clean;
    wordless items have no window.  Repeated document rows give a row each; rows of one item id count as one item;
    an item without an id hits but is not counted or listed.  Other columns are not read.  All of a very long text is
    searched; its words are places in one row.
    """
    windows = written(item_windows(items.select("item_id", "text"), window), "decontam-windows")
    grams = window_shingles(windows, shingle)
    lengths = sorted(row["k"] for row in grams.select("k").distinct().collect()) or [shingle]  # at most ``shingle`` values
    met = written(_meet(docs.select(*ids, "text"), list(ids), grams, lengths, window, broadcast_rows), "decontam-met")
    places = met.filter(F.col("gram").isNotNull())

    rarity = places.groupBy("gram").agg(F.count("*").alias("places"))
    counted = grams.select("win", "win_len", "off", F.array_join("g", " ").alias("gram")).join(rarity, "gram", "left")
    prefix = written(
        counted.groupBy("win", "win_len")
        .agg(
            F.min_by(F.struct("gram", "off"), F.struct(F.coalesce("places", F.lit(0)), "off")).alias("rarest"),
            F.min(F.coalesce("places", F.lit(0))).alias("least"),
        )
        .filter("least > 0")
        .select("win", "win_len", "rarest.*"),
        "decontam-prefix",
    )
    start = F.col("at") - F.col("off")
    fits = (start >= 0) & (start + F.col("win_len") <= F.col("n"))
    inside = F.array_join(F.slice("near", F.greatest(start - F.col("low"), F.lit(0)) + 1, F.col("win_len")), " ")
    occurrences = written(
        places.join(prefix, "gram").filter(fits & (inside == F.col("win"))).select("row", "win", "win_len", start.alias("start")),
        "decontam-occurrences",
    )
    listed = (
        occurrences.select("row", "win").distinct()
        .join(windows.select("win", "item_id").filter(F.col("item_id").isNotNull()).distinct(), "win")
        .groupBy("row").agg(F.collect_set("item_id").alias("found"))
    )
    every = met.filter(F.col("gram").isNull()).select("row", *ids, F.col("n").cast("long").alias("n_words"))
    found = F.coalesce("found", F.array().cast("array<bigint>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    listing = F.array_join(F.array_sort(F.transform(found, lambda x: x.cast("string"))), ",")
    return (
        every.join(_covered(occurrences), "row", "left")
        .join(listed, "row", "left")
        .select(
            *ids,
            "n_words",
            n_hit.alias("n_hit"),
            F.size(found).cast("long").alias("n_items"),
            F.sha2(listing, 256).alias("items_sha256"),
            ((n_hit > 0) & (n_hit * per_hit >= F.col("n_words"))).alias("contaminated"),
        )
    )


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the contaminated ones; only rows of the same doc_id, or of none, and the same text share their fate."""
    md5 = F.md5(F.col("text").cast("binary"))
    keyed = docs.select(F.col("doc_id").alias("bad_id"), md5.alias("bad_text"), "text")
    found = contamination(keyed, items, ids=("bad_id", "bad_text"))
    bad = written(found.filter("contaminated").select("bad_id", "bad_text").distinct(), "decontam-bad")
    same_text = F.md5(docs["text"].cast("binary")).eqNullSafe(bad["bad_text"])
    return docs.join(checked(bad), docs["doc_id"].eqNullSafe(bad["bad_id"]) & same_text, "left_anti")


SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
spread AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS begins FROM i WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, array_to_string(w[begins:begins + 12], ' ') AS win, len(w[begins:begins + 12]) AS l FROM spread),
lengths AS (SELECT DISTINCT l FROM win),
placed AS (SELECT r, l, w, unnest(range(1, len(w) - l + 2)) AS begins FROM d, lengths WHERE len(w) >= l),
runs AS (SELECT r, l, begins, array_to_string(w[begins:begins + l - 1], ' ') AS win FROM placed),
occ AS (SELECT r, runs.l, begins, item_id FROM runs JOIN win USING (win, l)),
hit AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(begins, begins + l)) AS p FROM occ) GROUP BY r),
its AS (
  SELECT r, count(*) AS n, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS s
  FROM (SELECT DISTINCT r, item_id FROM occ) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(its.n, 0)::BIGINT AS n_items,
  sha256(coalesce(its.s, '')) AS items_sha256,
  coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""
