"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target of words. A document's expected copies are in proportion to
its measure, the bit length of its number of words, so that longer documents are
likelier; they stop at the limit and add up to the target. Every document first gets
the whole copies that are certain; for the fraction ``p`` that is left, documents are
ranked by the random odds ``u / (1 - u)`` divided by the inclusion odds ``p / (1 - p)``,
and taken in that order up to the number of words that is left. DataFrame functions
only.

No source is sorted in one task: ranks are cut into slices whose word sums are
prefix-summed, and only a slice in which a source's target falls is sorted. The cut of
a Pareto sample is where both odds are about equal, and there a slice of ranks has at
most its even share of rows, whatever the probabilities are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tricycle.llm.words import word_count
from tricycle.plans import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2.0
SLICES = 4096  # of a source's ranks, at each of the two levels
# The measure that expected copies are in proportion to: a whole number from 1 to 64.
MEASURE = "length(bin(size))"
# Sources whose table of a few numbers each is broadcast; beyond it joins are shuffled.
BROADCAST_SOURCES = 100_000


def unit_hash(*columns: Column | str) -> Column:
    """A number in (0, 1) from the values, the same in every run: 52 bits of an MD5."""
    text = F.concat_ws(":", *[F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in columns])
    bits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / float(1 << 52)


def source_targets(
    sizes: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    limit: float = LIMIT,
) -> DataFrame:
    """``(source, source_size, weight, target)`` for the rows ``(source, source_size)``.

    Sources in code-point order, null last, have the weights in turn and share
    ``share`` of all words by weight. A target stops at ``limit`` times its source's
    size; the excess goes to the others by weight until none is above, or until all
    are full. One small row per source: the aggregation before has bounded them by
    the number of sources, and each round only moves two sums to the driver.
    """
    # Ranks without a global sort in one task: the place in a range-partitioned,
    # written table, from a prefix sum over its partitions.
    spread = sizes.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    spread = materialize(spread, "sources")
    counts = spread.groupBy("part").count()
    before = counts.select(
        "part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before")
    )  # at most one row for each partition
    within = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    values = F.array(*[F.lit(float(w)) for w in weights])
    ranked = (
        spread.join(F.broadcast(before), "part")
        .withColumn("place", (F.col("before") + within - 1) % len(weights))
        .select("source", "source_size", F.get(values, F.col("place").cast("int")).alias("weight"))
    )
    ranked = materialize(ranked, "weights")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    # Targets are min(limit * size, level * weight); the level rises until it settles.
    level = 0.0
    while True:
        full = F.col("weight") * level >= limit * F.col("source_size")
        taken, left = ranked.agg(
            F.sum(F.when(full, F.col("source_size"))), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if not left:
            break
        higher = (share * total - limit * (taken or 0)) / left
        if higher <= level:
            break
        level = higher
    return ranked.withColumn("target", F.least(limit * F.col("source_size"), F.col("weight") * level))


def expected_copies(classes: DataFrame, limit: float = LIMIT) -> DataFrame:
    """``classes``, rows ``(source, measure, words, target)``, with ``expected`` copies.

    These are ``level * measure`` up to ``limit``, with a level for each source at which
    its words times expected copies are its target. Measures are few, so a source is a
    few rows: the largest measures are full, and the level is that of the first which is
    not, by sums over the measures above and below it.
    """
    source = ["source"]
    above = Window.partitionBy(*source).orderBy(F.col("measure").desc())
    below = Window.partitionBy(*source).orderBy("measure")
    full = F.sum("words").over(above) - F.col("words")
    rest = F.sum(F.col("measure") * F.col("words")).over(below)
    level = (F.col("target") - F.lit(limit) * full) / F.nullif(rest, F.lit(0))
    fits = F.when(F.col("level") * F.col("measure") <= limit, F.col("measure"))
    return (
        classes.withColumn("level", level)
        .withColumn("level", F.max_by("level", fits).over(Window.partitionBy(*source)))
        .withColumn("level", F.expr("if(target > 0, coalesce(level, double('inf')), 0D)"))
        .withColumn("expected", F.least(F.lit(limit), F.col("level") * F.col("measure")))
        .drop("level")
    )


def sampled_mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    limit: float = LIMIT,
    slices: int = SLICES,
) -> DataFrame:
    """``(doc_id, size, source_size, target, copies, taken)`` for each row of ``docs``.

    ``size`` counts words, ``source_size`` and ``target`` are its source's words
    there and wanted, ``copies`` how often the mix takes the document and ``taken``
    the words of these copies. A source's taken words come as near to its target as
    its last document allows; no document has more than ``limit`` copies, rounded up.

    Null texts and texts without words have size 0 and the least measure, and take no
    words. A null source is a source of its own, a null doc_id is ranked by its text.
    Rows equal in id and size are ranked alike and told apart by nothing: of those at
    the cut all or, if they are more than half over, none are taken. Further
    columns are ignored; an empty table gives an empty result.
    """
    return _planned(docs, weights, share, limit, slices).select(
        "doc_id", "size", "source_size", "target", "copies", "taken"
    )


def _planned(docs: DataFrame, weights: tuple[float, ...], share: float, limit: float, slices: int) -> DataFrame:
    """The mix with each row's number ``u`` and its source's ``name``."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text").cast("string")).alias("size"),
        unit_hash(F.col("doc_id").cast("string"), F.when(F.col("doc_id").isNull(), F.col("text").cast("string"))).alias("u"),
    )
    rows = materialize(rows, "sizes")
    rows = rows.withColumn("measure", F.expr(MEASURE))
    classes = materialize(rows.groupBy("source", "measure").agg(F.sum("size").alias("words")), "measures")
    sources = classes.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sources, weights, share, limit)
    # A table with a few rows for each source joins rows of which one source may have a third.
    lookup = F.broadcast if targets.count() <= BROADCAST_SOURCES else (lambda table: table)
    targets = classes.join(
        targets.withColumnRenamed("source", "other"), F.col("source").eqNullSafe(F.col("other"))
    ).drop("other")
    targets = expected_copies(targets, limit).withColumn("certain", F.expr("floor(expected)"))
    left = "target - sum(certain * words) OVER (PARTITION BY source)"
    targets = materialize(targets.withColumn("left", F.expr(left)), "targets").select(
        F.coalesce("source", F.lit("")).alias("name"),
        F.col("source").isNull().alias("unnamed"),
        "measure",
        "source_size",
        "target",
        "certain",
        "left",
        F.expr("expected - certain").alias("p"),
    )
    ranked = (
        rows.withColumns({"name": F.coalesce("source", F.lit("")), "unnamed": F.col("source").isNull()})
        .join(lookup(targets), ["name", "unnamed", "measure"])
        .withColumn("q", F.expr("if(p > 0, (u / (1 - u)) / (p / (1 - p)), double('inf'))"))
        .withColumn("place", F.expr(f"if(p > 0, q / (1 + q), 1D) * {slices}"))
        .withColumn("slice", F.expr(f"least(int(place), {slices - 1})"))
        .withColumn("part", F.expr(f"least(int((place - slice) * {slices}), {slices - 1})"))
        .drop("place")
    )
    ranked = materialize(ranked.drop("name", "unnamed"), "ranked")
    source = [F.coalesce("source", F.lit("")).alias("name"), F.col("source").isNull().alias("unnamed")]
    keyed = ranked.select("*", *source)
    by = ["name", "unnamed"]

    def cut(sums: DataFrame, keys: list[str], column: str) -> DataFrame:
        """The words before each group of rows in order of ``column``."""
        over = Window.partitionBy(*keys).orderBy(column)
        return sums.withColumn("until", F.sum("words").over(over)).withColumn("before", F.col("until") - F.col("words"))

    first = cut(keyed.groupBy(*by, "slice").agg(F.sum("size").alias("words"), F.first("left").alias("left")), by, "slice")
    at = first.where("before < left AND until >= left").select(*by, "slice", "before")
    inner = (
        keyed.join(lookup(at.withColumnRenamed("before", "earlier")), [*by, "slice"])
        .groupBy(*by, "slice", "part")
        .agg(F.sum("size").alias("words"), F.first("left").alias("left"), F.first("earlier").alias("earlier"))
    )
    inner = cut(inner, [*by, "slice"], "part")
    last = inner.where("earlier + before < left AND earlier + until >= left").select(
        *by, "slice", "part", (F.col("earlier") + F.col("before")).alias("earlier")
    )
    place = Window.partitionBy(*by).orderBy("q")
    edge = (
        keyed.join(lookup(last), [*by, "slice", "part"])
        .groupBy(*by, "q", "left", "earlier")
        .agg(F.sum("size").alias("words"))
        .withColumn("until", F.col("earlier") + F.sum("words").over(place))
        # A rank at the cut is taken if that leaves less over than it would leave out.
        .where("until - left <= left - (until - words)")
        .groupBy(*by)
        .agg(F.max("q").alias("bound"))
    )
    start = last.select(*by, "slice", "part").join(edge, by, "left").withColumnsRenamed({"slice": "cut_slice", "part": "cut_part"})
    taken = """certain + CASE
        WHEN p <= 0 OR cut_slice IS NULL THEN 0
        WHEN slice <> cut_slice THEN int(slice < cut_slice)
        WHEN part <> cut_part THEN int(part < cut_part)
        ELSE int(coalesce(q <= bound, false)) END"""
    return (
        keyed.join(lookup(start), by, "left")
        .withColumn("copies", F.expr(taken).cast("long"))
        .withColumn("taken", F.col("size") * F.col("copies"))
    )


def mixed(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT
) -> DataFrame:
    """The documents that ``sampled_mix`` takes, with all their columns, and ``copies``
    (1 or more), ``size`` and ``taken`` in words. Columns of these names are replaced.
    """
    def keys(doc_id: str, text: str) -> list[Column]:
        return [
            F.coalesce(F.col(doc_id).cast("long"), F.lit(0)).alias("id"),
            unit_hash(F.col(doc_id).cast("string"), F.when(F.col(doc_id).isNull(), F.col(text).cast("string"))).alias("u"),
            F.coalesce(F.col(doc_id.replace("doc_id", "source")).cast("string"), F.lit("")).alias("name"),
            F.col(doc_id.replace("doc_id", "source")).isNull().alias("unnamed"),
            word_count(F.col(text).cast("string")).alias("size"),
        ]

    own = [F.col(f"doc.{c}").alias(c) for c in docs.columns if c.lower() not in ("copies", "size", "taken")]
    rows = docs.select(F.struct("*").alias("doc")).select(*keys("doc.doc_id", "doc.text"), "doc")
    plan = _planned(docs, weights, share, limit, SLICES).where("copies > 0").select(
        F.coalesce("doc_id", F.lit(0)).alias("id"), "u", "name", "unnamed", "size", "copies", "taken"
    )
    by = ["id", "u", "name", "unnamed", "size"]
    return rows.join(plan.dropDuplicates(by), by).select(*own, "copies", "size", "taken")
