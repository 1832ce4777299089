"""Mixing sources to target weights by Sainte-Laguë apportionment of token blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiltwatch.llm.common import SPACE_CLASS, keep, word_count
from tiltwatch.llm.sharding import key_hash


#: Quantiles that part the quotients of a group, so that only those around the last seat are ranked together.
PARTS = 256


def apportion(parties: DataFrame, groups: list[str], key: str, weight: str, seats: str) -> DataFrame:
    """``parties`` with ``quota``: whole seats by the highest quotients weight / (2k - 1).

    ``seats`` is the number to give within each group, ``key`` is unique there
    and breaks ties. For n parties the divisor that gives out all seats lies
    between total / (seats + n/2) and total / (seats - n/2); so only the few
    quotients between these two counts, about two per party, are compared.
    They are parted at quantiles and counted per part; parts above the last seat win whole,
    and only the part that it falls into is ranked. So a group may have any number of
    parties. Parties with no weight get no seats.
    """
    parties = keep(parties, "parties")
    sums = parties.groupBy(*groups).agg(
        F.sum(weight).alias("total_"), F.sum(F.when(F.col(weight) > 0, 0.5).otherwise(0.0)).alias("half_")
    )
    near = lambda count: F.floor(F.col(weight) * count / F.col("total_") + 0.5)
    none = (F.col(weight) <= 0) | (F.col(seats) <= 0)
    bounded = keep(
        parties.join(sums, groups).withColumns({
            "low_": F.when(none, 0).otherwise(
                F.greatest(F.lit(0), near(F.col(seats) - F.col("half_")) - 1)
            ).cast("long"),
            "high_": F.when(none, 0).otherwise(near(F.col(seats) + F.col("half_")) + 1).cast("long"),
        }).drop("total_", "half_"),
        "bounded",
    )
    spare = bounded.groupBy(*groups).agg((F.max(seats) - F.sum("low_")).alias("spare_"))
    ranked = bounded.filter(F.col("high_") > F.col("low_")).select(
        *groups, key, F.explode(F.sequence(F.col("low_") + 1, F.col("high_"))).alias("seat_"), F.col(weight).alias("w_")
    ).withColumn("quotient_", F.col("w_") / (2 * F.col("seat_") - 1)).drop("w_")
    cuts = ranked.groupBy(*groups).agg(
        F.percentile_approx("quotient_", [i / PARTS for i in range(1, PARTS)], 10_000).alias("cuts_")
    )
    parted = keep(
        ranked.join(cuts.join(spare, groups), groups)
        .withColumn("part_", F.size(F.filter("cuts_", lambda c: c > F.col("quotient_")))).drop("cuts_"),
        "quotients",
    )
    counts = parted.groupBy(*groups, "part_").agg(F.count(F.lit(1)).alias("n_"))
    higher = Window.partitionBy(*groups).orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    placed = parted.join(
        counts.withColumn("before_", F.coalesce(F.sum("n_").over(higher), F.lit(0))), [*groups, "part_"]
    )
    winning = placed.filter(F.col("before_") + F.col("n_") <= F.col("spare_")).select(*groups, key)
    place = F.row_number().over(Window.partitionBy(*groups).orderBy(F.desc("quotient_"), key, "seat_"))
    last = placed.filter((F.col("before_") < F.col("spare_")) & (F.col("before_") + F.col("n_") > F.col("spare_")))
    last = last.withColumn("place_", place).filter(F.col("before_") + F.col("place_") <= F.col("spare_"))
    won = winning.unionAll(last.select(*groups, key)).groupBy(*groups, key).agg(F.count(F.lit(1)).alias("won_"))
    return (
        bounded.join(won, [*groups, key], "left")
        .withColumn("quota", F.col("low_") + F.coalesce("won_", F.lit(0)))
        .drop("low_", "high_", "won_")
    )


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...], share: float, copies: int
) -> DataFrame:
    """``number, source, source_size, target`` from ``(source, source_size)``.

    Sources are numbered by code point, NULL last, and weigh ``weights`` in
    turn. They share ``share`` times all words; a target stops at ``copies``
    times its source's words and the excess is shared again by weight. With
    sources in the order of limit / weight, those below one level stop at
    their limit and the others get level times weight, so the level follows
    from running sums. One row per source is all that meets in one task.
    """
    every = Window.orderBy(F.asc_nulls_last("source"))
    numbered = sizes.withColumn("number", F.row_number().over(every))
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), ((F.col("number") - 1) % len(weights) + 1).cast("int")
    )
    rows = numbered.withColumn("weight", weight).withColumn(
        "limit", (F.col("source_size") * copies).cast("double")
    )
    rows = rows.withColumn("ratio", F.col("limit") / F.col("weight"))
    before = Window.orderBy("ratio", "number").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy("ratio", "number").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    rows = rows.withColumn("pool", F.sum("source_size").over(whole) * F.lit(share))
    level = (F.col("pool") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    rows = rows.withColumn("level", level)
    reached = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "number", "level"))).over(whole)
    rows = rows.withColumn("stop", reached["level"])
    target = F.when(F.col("stop").isNull(), F.col("limit")).otherwise(
        F.least("limit", F.col("stop") * F.col("weight"))
    )
    return rows.select("number", "source", "source_size", target.alias("target"), "pool")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    copies: int = 2,
    block: int = 32,
    shard_words: int = 1_000_000,
    seed: str = "mix-0",
) -> DataFrame:
    """``docs`` with ``_size``, ``_source_size``, ``_target`` and ``_taken`` words.

    The mix is made of blocks of ``block`` words. Sainte-Laguë apportionment
    gives each source whole blocks by its target, and each shard of a source
    whole blocks by its size. A shard is a draw by seeded hash of about
    ``shard_words`` words, so a source with a third of all rows is many
    shards. The seed also puts the documents of a shard in order; the mix
    takes the shard whole as often as its blocks allow, then the first blocks
    of that order. A document cut by the last block gives its first words.

    Every text is read twice, to count and hash it and to give the rows out. Results depend on rows and seed alone. NULL texts have no words; documents
    without words are never taken. Rows that agree in id and text are
    interchangeable. NULL sources are one source, the last. An empty table
    gives an empty result. Columns named like the added ones are replaced.
    """
    added = ["_size", "_source_size", "_target", "_taken"]
    inner = ["__mix_h", "__mix_n", "__mix_shards", "__mix_shard", "__mix_quota", "__mix_words", "__mix_end"]
    data = docs.drop(*added, *inner)
    col = lambda name: F.col(f"`{name}`")
    rows = data.withColumns({
        "_size": word_count(col(text_col)),
        "__mix_h": key_hash(F.lit(seed), col(id_col), col(text_col)),
    })
    slim = keep(
        rows.select(F.col("__mix_h").alias("h"), col(source_col).alias("source"), F.col("_size").alias("size")),
        "mix-sizes",
    )
    targets = source_targets(
        slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, copies
    )
    targets = targets.withColumns({
        "all": F.lit(0), "blocks": F.floor(F.col("pool") / block + 0.5)
    })
    recipe = keep(
        apportion(targets, ["all"], "number", "target", "blocks").select(
            "number", "source", "source_size", "target", F.col("quota").alias("source_blocks"),
            F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).alias("shards"),
        ),
        "mix-recipe",
    )
    same = lambda left, right: left.eqNullSafe(right)
    sharded = slim.join(recipe, same(slim["source"], recipe["source"])).groupBy(
        "number", "source_blocks", F.pmod("h", "shards").alias("shard")
    ).agg(F.sum("size").alias("words"))
    quotas = keep(
        apportion(sharded, ["number"], "shard", "words", "source_blocks").select(
            F.col("number").alias("__mix_n"), F.col("shard").alias("__mix_shard"),
            F.col("words").alias("__mix_words"), (F.col("quota") * block).alias("__mix_quota"),
        ),
        "mix-quotas",
    )
    named = recipe.select(
        F.col("source").alias("__mix_source"), F.col("number").alias("__mix_n"),
        F.col("shards").alias("__mix_shards"), F.col("source_size").alias("_source_size"),
        F.col("target").alias("_target"),
    )
    rows = (
        rows.join(named, same(rows[f"`{source_col}`"], named["__mix_source"]))
        .drop("__mix_source")
        .withColumn("__mix_shard", F.pmod("__mix_h", "__mix_shards"))
    )
    order = Window.partitionBy("__mix_n", "__mix_shard").orderBy("__mix_h", col(id_col), "_size")
    rows = rows.withColumn(
        "__mix_end", F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ).join(quotas, ["__mix_n", "__mix_shard"])
    quota, words = F.col("__mix_quota"), F.col("__mix_words")
    whole = F.when(words > 0, F.least(F.lit(copies), F.floor(quota / words))).otherwise(0).cast("long")
    rest = F.when(whole < copies, quota - whole * words).otherwise(F.lit(0))
    part = F.greatest(F.lit(0), F.least("__mix_end", rest) - (F.col("__mix_end") - F.col("_size")))
    return rows.withColumn("_taken", (whole * F.col("_size") + part).cast("long")).select(
        *[col(c) for c in data.columns], *added
    )


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th word, for texts of more words than that."""
    led = F.regexp_like(text, F.lit(rf"\A{SPACE_CLASS}")).cast("int")
    # The last part of a split into so many is all that follows the words taken.
    rest = F.element_at(F.split(text, f"{SPACE_CLASS}+", (n + 1 + led).cast("int")), -1)
    return F.regexp_replace(text.substr(F.lit(1), F.length(text) - F.length(rest)), rf"{SPACE_CLASS}+\z", "")


def take(mixed: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of a mix: each document as often as it was taken whole, and its cut part if any.

    The columns that :func:`mix` added are gone. Documents without words,
    NULL texts among them, are never taken; repeated rows are taken each by
    its own number; other columns are carried along; no rows give none.
    """
    size, taken = F.col("_size"), F.col("_taken")
    whole = F.floor(taken / size).cast("int")
    parts = F.concat(
        F.array_repeat(size, whole),
        F.when(taken % size > 0, F.array(taken % size)).otherwise(F.array().cast("array<bigint>")),
    )
    rows = mixed.filter((size > 0) & (taken > 0)).withColumn("__mix_part", F.explode(parts))
    text = F.col(f"`{text_col}`")
    cut = F.when(F.col("__mix_part") < size, first_words(text, F.col("__mix_part"))).otherwise(text)
    return rows.withColumn(text_col, cut).drop("_size", "_source_size", "_target", "_taken", "__mix_part")
