"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Every source gets a target number of words: its weight's share of the mix,
   never more than a multiple of its size; what it cannot use is shared out again
   by weight until no source is above.
2. The documents of a source, in a hashed order, are laid end to end, and its words
   are cut into blocks, a power of two of them that differ in size by a word at
   most. A source's quota is the number of blocks that its target fills.
3. A binary tree over the output shards splits the quotas. At each node the blocks
   that go left are a multivariate-hypergeometric draw: source after source, a
   hypergeometric draw from what is left. Sums are kept exactly at every node, so
   a shard knows how many blocks of each source it takes and where they start.
4. A bijection on block numbers, made of shifts and odd multiplications, permutes
   the blocks of a source; a shard takes its range of permuted blocks. Ranges are
   disjoint, so no block is taken twice before all have been taken once.
5. Rows are shuffled inside their shard by a hash.

Everything is made of DataFrame functions, and the draws depend only on the seed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tallymill.llm.rows import column, packed, row_digest, unpacked
from tallymill.session import written

SEED = 20_240_229

#: The weights of the sources in code-point order, repeating.
WEIGHTS = (3, 1, 2)
#: The mix has this share of all words, and no document is used more often than this.
SHARE = 1.5
MOST_TIMES = 2

SHARDS = 16
#: Words of a block; half of it at least, unless the source is smaller.
BLOCK_WORDS = 4096
MOST_BLOCKS_LOG2 = 40

#: Hash ranges (their log2) over which the documents of one source are spread and added up.
RANGES_LOG2 = 12

WORD = r"[^\x20\x09-\x0D]+"


def _sized(text_column: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_column), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most_times: int = MOST_TIMES
) -> DataFrame:
    """``target`` of every row of (``_key``, ``source``, ``source_size``), one row per source.

    Sources are weighed in code-point order, null last. With r(s) = size / weight,
    the sources that end at their limit are those with the smallest r: in that
    order each prefix of limited sources leaves a level for the others, and the
    prefix ends where the level no longer exceeds the next source's limit.
    """
    by_name = W.partitionBy(F.lit(0)).orderBy(F.col("source").isNull(), F.col("source"))
    limit = (F.col("source_size") * most_times).cast("double")
    # One row per source: these windows hold the list of sources, not their rows.
    weighed = totals.withColumn("_no", F.row_number().over(by_name) - 1).withColumn(
        "_weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("_no") % len(weights) + 1).cast("int")).cast("double")
    )
    every = W.partitionBy(F.lit(0))
    by_need = every.orderBy(limit / F.col("_weight"), "_no")
    earlier = by_need.rowsBetween(W.unboundedPreceding, -1)
    weighed = weighed.withColumns(
        {
            "_used": F.coalesce(F.sum(limit).over(earlier), F.lit(0.0)),
            "_left": F.sum("_weight").over(every) - F.coalesce(F.sum("_weight").over(earlier), F.lit(0.0)),
            "_mix": F.sum("source_size").over(every) * share,
        }
    )
    level = (F.col("_mix") - F.col("_used")) / F.col("_left")
    is_open = level * F.col("_weight") <= limit
    weighed = weighed.withColumn("_level", F.min(F.when(is_open, F.struct(limit / F.col("_weight"), F.col("_no"), level))).over(every)["col3"])
    target = F.when(F.col("_level").isNull(), limit).otherwise(F.least(limit, F.col("_level") * F.col("_weight")))
    return weighed.select("_key", "source_size", "_no", target.alias("target"))


def _blocks_of(size: Column) -> Column:
    """log2 of the number of blocks of a source."""
    wanted = F.greatest(size / F.lit(float(BLOCK_WORDS)), F.lit(1.0))
    return F.least(F.ceil(F.log2(wanted)), F.lit(MOST_BLOCKS_LOG2)).cast("int")


def _power_of_two(exponent: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), exponent)


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def permuted(block: Column, log2_blocks: Column, salt: Column) -> Column:
    """The place of a block in a permutation of 0 .. 2^log2_blocks - 1.

    Each step is a bijection: adding, multiplying by an odd number, and xor with
    the upper half, all modulo the power of two.
    """
    mask = _power_of_two(log2_blocks) - 1
    half = F.greatest(F.lit(1), F.ceil(log2_blocks / 2)).cast("int")
    value = block
    for step in range(3):
        odd = F.xxhash64(salt, F.lit(2 * step)).bitwiseAND(F.lit((1 << 20) - 1)) * 2 + 1
        add = F.xxhash64(salt, F.lit(2 * step + 1)).bitwiseAND(F.lit((1 << 40) - 1))
        value = _let(
            ((value + add).bitwiseAND(mask) * odd).bitwiseAND(mask),
            lambda v: v.bitwiseXOR(F.call_function("shiftright", v, half)),
        )
    return value


def _log_factorial(n: Column) -> Column:
    """ln n!, by the terms of Stirling's series at n + 8, taken back to n."""
    x = n + 8
    series = (x + 0.5) * F.log(x) - x + 0.9189385332046727 + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    back = F.lit(0.0)
    for i in range(1, 9):
        back = back + F.log(n + i)
    return series - back


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def hypergeometric(total: Column, marked: Column, drawn: Column, uniform: Column) -> Column:
    """How many of ``marked`` among ``total`` are in a draw of ``drawn``, by inversion.

    The probabilities are followed outwards from the mode, nearest first, until
    they add up to ``uniform``; beyond twelve standard deviations nothing is left.
    """
    given = F.struct(
        total.cast("double").alias("n"), marked.cast("double").alias("k"), drawn.cast("double").alias("d"),
        uniform.alias("u"),
    )

    def ends(g: Column) -> Column:
        low, high = F.greatest(F.lit(0.0), g["d"] + g["k"] - g["n"]), F.least(g["k"], g["d"])
        peak = F.floor((g["d"] + 1) * (g["k"] + 1) / (g["n"] + 2)).cast("double")
        return F.struct(low.alias("low"), high.alias("high"), F.least(high, F.greatest(low, peak)).alias("mode"))

    def log_choices(g: Column, mode: Column) -> Column:
        n, k, d = g["n"], g["k"], g["d"]
        plus, minus = [k, n - k, d, n - d], [mode, k - mode, d - mode, n - k - d + mode, n]
        logs = F.transform(F.array(*plus, *minus), _log_factorial)
        return F.exp(F.aggregate(F.slice(logs, 1, 4), F.lit(0.0), lambda a, x: a + x) - F.aggregate(F.slice(logs, 5, 5), F.lit(0.0), lambda a, x: a + x))

    def walk(g: Column, e: Column, at_mode: Column) -> Column:
        n, k, d = g["n"], g["k"], g["d"]
        share = k / F.greatest(n, F.lit(1.0))
        reach = F.ceil(12 * F.sqrt(d * share * (1 - share) + 1) + 12).cast("int")
        start = F.struct(
            (g["u"] <= at_mode).alias("done"), e["mode"].alias("found"), (g["u"] - at_mode).alias("u"),
            e["mode"].alias("a"), at_mode.alias("pa"), e["mode"].alias("b"), at_mode.alias("pb"),
        )

        def sides(s: Column) -> Column:
            a, b = s["a"], s["b"]
            p_down = s["pa"] * a * (n - k - d + a) / ((k - a + 1) * (d - a + 1))
            p_up = s["pb"] * (k - b) * (d - b) / ((b + 1) * (n - k - d + b + 1))
            return F.struct(
                F.when(a > e["low"], p_down).otherwise(0.0).alias("pa"), F.when(b < e["high"], p_up).otherwise(0.0).alias("pb")
            )

        def step(s: Column, _: Column) -> Column:
            return _let(
                sides(s),
                lambda p: F.struct(
                    (s["done"] | (s["u"] <= p["pa"] + p["pb"])).alias("done"),
                    F.when(s["done"] | (s["u"] > p["pa"] + p["pb"]), s["found"])
                    .when(s["u"] <= p["pa"], s["a"] - 1)
                    .otherwise(s["b"] + 1)
                    .alias("found"),
                    (s["u"] - p["pa"] - p["pb"]).alias("u"),
                    F.greatest(s["a"] - 1, e["low"]).alias("a"),
                    p["pa"].alias("pa"),
                    F.least(s["b"] + 1, e["high"]).alias("b"),
                    p["pb"].alias("pb"),
                ),
            )

        return F.aggregate(F.sequence(F.lit(1), reach), start, step, lambda s: s["found"])

    return _let(
        given, lambda g: _let(ends(g), lambda e: _let(log_choices(g, e["mode"]), lambda p: walk(g, e, p)))
    ).cast("long")


def shard_quotas(quotas: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(``source``, ``shard``, ``first``, ``blocks``): how the quotas of the sources are split.

    ``quotas`` has ``_no`` and ``quota`` (blocks) per source. The table has one row
    per source and shard. At each node of the tree the left side holds half of the
    blocks; the sources draw in turn from what the earlier ones have left.
    """
    depth = max(shards - 1, 0).bit_length()
    if 1 << depth != shards:
        raise ValueError("the number of shards must be a power of two")
    nodes = quotas.select("_no", "quota", F.lit(0).alias("node"))
    for level in range(depth):
        lists = nodes.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("_no", "quota"))).alias("items"))
        whole = F.aggregate("items", F.lit(0).cast("long"), lambda s, x: s + x["quota"])
        start = F.struct(whole.alias("left"), F.floor(whole / 2).cast("long").alias("spare"), F.array().cast("array<bigint>").alias("taken"))

        def draw(s: Column, x: Column) -> Column:
            u = F.pmod(F.xxhash64(F.lit(seed), F.lit(level), F.col("node"), x["_no"]), F.lit(1 << 52)) / float(1 << 52)
            return _let(
                hypergeometric(s["left"], x["quota"], s["spare"], u),
                lambda got: F.struct(
                    (s["left"] - x["quota"]).alias("left"),
                    (s["spare"] - got).alias("spare"),
                    F.concat(s["taken"], F.array(got)).alias("taken"),
                ),
            )

        split = lists.select(
            "node", F.explode(F.arrays_zip("items", F.aggregate("items", start, draw, lambda s: s["taken"]).alias("taken"))).alias("x")
        ).select("node", "x.items._no", "x.items.quota", "x.taken")
        sides = F.array(
            F.struct((F.col("node") * 2).alias("node"), F.col("taken").alias("quota")),
            F.struct((F.col("node") * 2 + 1).alias("node"), (F.col("quota") - F.col("taken")).alias("quota")),
        )
        nodes = split.select("_no", F.explode(sides).alias("s")).select("_no", "s.quota", "s.node")
        nodes = written(nodes, "shard-quotas")
    earlier = W.partitionBy("_no").orderBy("node").rowsBetween(W.unboundedPreceding, -1)
    return nodes.select(
        "_no", F.col("node").alias("shard"), F.coalesce(F.sum("quota").over(earlier), F.lit(0)).alias("first"),
        F.col("quota").alias("blocks"),
    )


def mixed(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
    weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, shards: int = SHARDS, seed: int = SEED,
) -> DataFrame:
    """Every document with its place in the mix.

    Columns ``id``, ``a`` and ``b`` (digests of all columns of the row), ``start``
    (its first word among those of its source), ``size``, ``source_size``,
    ``target`` and ``pieces``, an array (null for size 0) of the pieces taken:
    ``epoch``, ``block``, ``shard``, ``place`` (its order in the shard) and the
    words ``from_word`` (from 0) to ``to_word``.

    Null and empty texts have size 0, and nothing of them is taken. Null is a
    source like any other, in last place. Rows that are equal are laid side by
    side and taken each on its own account. An empty table gives an empty one.
    Other columns, whatever their names, only tell rows apart.
    """
    sized = docs.select(
        column(id_column).alias("id"),
        column(source_column).alias("source"),
        _sized(text_column).alias("size"),
        F.xxhash64(F.lit(0), column(text_column)).alias("text_hash"),
        row_digest(docs).alias("digest"),
    )
    sized = sized.select("*", "digest.*").drop("digest")
    row = F.xxhash64(F.lit(seed), F.col("id"), F.col("text_hash"))
    sized = sized.withColumns(
        {
            # The source as a key without nulls, so that joins and windows share a partitioning.
            "_key": F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")),
            "_row": row,
            "_range": F.shiftright(row, 64 - RANGES_LOG2),
        }
    )
    sized = written(sized, "sizes")
    # The ranges of a source are added up first; a range is a small part of a source.
    sums = sized.groupBy("_key", "_range").agg(F.sum("size").alias("_words"), F.first("source").alias("source"))
    before = W.partitionBy("_key").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = written(sums.withColumn("_offset", F.coalesce(F.sum("_words").over(before), F.lit(0))), "offsets")
    totals = offsets.groupBy("_key").agg(F.sum("_words").alias("source_size"), F.first("source").alias("source"))
    targets = source_targets(totals, weights, share).withColumn("_log2", _blocks_of(F.col("source_size")))
    blocks = _power_of_two(F.col("_log2"))
    # Blocks taken in full over all rounds, and the part taken of one more.
    filled = F.col("target") * blocks / F.greatest(F.col("source_size"), F.lit(1))
    targets = targets.withColumn("quota", F.floor(filled).cast("long")).withColumn("_part", filled - F.col("quota"))
    targets = written(targets, "targets")
    plan = shard_quotas(targets.select("_no", "quota"), shards, seed)
    starts = plan.groupBy("_no").agg(F.sort_array(F.collect_list(F.struct("first", "shard"))).alias("_shards"))
    per_source = targets.join(starts, "_no")
    per_range = offsets.select("_key", "_range", "_offset").join(per_source, "_key")
    here = sized.join(per_range, ["_key", "_range"])
    in_range = W.partitionBy("_key", "_range").orderBy("_row", "id", "size", "a", "b").rowsBetween(W.unboundedPreceding, -1)
    here = here.withColumn("_start", F.col("_offset") + F.coalesce(F.sum("size").over(in_range), F.lit(0)))
    return here.select(
        "id", "a", "b", F.col("_start").alias("start"), "size", "source_size", "target", _pieces(seed).alias("pieces")
    )


def _pieces(seed: int) -> Column:
    """What the mix takes of a row: its words lie from ``_start`` on among those of its source."""
    blocks, total = _power_of_two(F.col("_log2")), F.col("source_size")
    start, end, quota = F.col("_start"), F.col("_start") + F.col("size"), F.col("quota")

    def block_at(word: Column) -> Column:
        """The block of a word: the last one that starts at or before it."""
        return _div((word + 1).cast("decimal(38,0)") * blocks - 1, total)

    def block_start(block: Column) -> Column:
        return _div(block.cast("decimal(38,0)") * total, blocks)

    def piece(epoch: int):
        salt = F.xxhash64(F.lit(seed), F.col("_no"), F.lit(epoch))

        def of(block: Column) -> Column:
            return _let(
                F.struct(
                    block_start(block).alias("low"),
                    block_start(block + 1).alias("high"),
                    (epoch * blocks + permuted(block, F.col("_log2"), salt)).alias("rank"),
                ),
                lambda b: placed(block, b["low"], b["high"], b["rank"]),
            )

        def placed(block: Column, low: Column, high: Column, rank: Column) -> Column:
            # All words of the block, or of the last one its first part.
            upto = (
                F.when(rank < quota, high)
                .when(rank == quota, low + F.round(F.col("_part") * (high - low)).cast("long"))
                .otherwise(low)
            )
            # A source's part of a block goes to a shard of its own choice, so that no shard gets all of them.
            any_shard = (F.pmod(F.xxhash64(F.lit(seed), F.col("_no")), F.size("_shards")) + 1).cast("int")
            shard = F.when(
                rank < quota, F.element_at(F.filter("_shards", lambda s: s["first"] <= rank), -1)["shard"]
            ).otherwise(F.element_at("_shards", any_shard)["shard"])
            return F.struct(
                F.lit(epoch).alias("epoch"),
                block.alias("block"),
                shard.alias("shard"),
                F.xxhash64(F.lit(seed), F.col("_key"), F.lit(epoch), block, F.col("_row")).alias("place"),
                (F.greatest(start, low) - start).alias("from_word"),
                (F.least(end, upto) - start).alias("to_word"),
            )

        return of

    covered = F.sequence(block_at(start), block_at(F.greatest(end - 1, start)))
    every = F.concat(*[F.transform(covered, piece(epoch)) for epoch in range(MOST_TIMES)])
    taken = F.filter(every, lambda p: p["to_word"] > p["from_word"])
    return F.when(F.col("size") > 0, taken)


def mixture(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", **options
) -> DataFrame:
    """(id, ``size``, ``source_size``, ``target``, ``taken``, ``shards``) of every row; see ``mixed``.

    ``taken`` is the number of words that the mix takes of the row, repeats counted, and
    ``shards`` has the words of it that each shard gets.
    """
    words = lambda p: p["to_word"] - p["from_word"]
    add_up = lambda pieces: F.aggregate(pieces, F.lit(0).cast("long"), lambda n, p: n + words(p))
    shards = F.transform(
        F.array_sort(F.array_distinct(F.transform(F.col("pieces"), lambda p: p["shard"]))),
        lambda shard: F.struct(shard.alias("shard"), add_up(F.filter(F.col("pieces"), lambda p: p["shard"] == shard)).alias("words")),
    )
    return mixed(docs, id_column, text_column, source_column, **options).select(
        F.col("id").alias(id_column), "size", "source_size", "target",
        F.coalesce(add_up(F.col("pieces")), F.lit(0)).alias("taken"),
        F.coalesce(shards, F.array().cast("array<struct<shard:int,words:bigint>>")).alias("shards"),
    )


def take(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", **options
) -> DataFrame:
    """The mix itself: a row with the columns of ``docs`` for each document, round and shard that takes some of it.

    The text of a row that is taken whole is unchanged; of others, the words taken
    with the white space before each. Every shard gets the words that the tree gives it.
    Rows are ordered at random within a shard, and every shard is one range of the
    result. Rows equal in all columns are taken each on its own account.
    """
    placed = mixed(docs, id_column, text_column, source_column, **options)
    spans = F.sort_array(F.collect_list(F.struct("p.from_word", "p.to_word"))).alias("spans")
    rounds = (
        placed.select("a", "b", "start", "size", F.explode_outer("pieces").alias("p"))
        .groupBy("a", "b", "start", "size", "p.epoch", "p.shard")
        .agg(F.min("p.place").alias("place"), spans)
    )
    rounds = written(rounds, "taken")
    key = ["a", "b"]
    rows = packed(docs, digest=row_digest(docs), text=column(text_column)).select("row", "text", "digest.*")
    # Of equal rows, which have a start each, one goes in: each of its starts gives rows of its own.
    again = rounds.groupBy(*key).agg(F.min("start").alias("low"), F.max("start").alias("high")).filter("low < high").select(*key)
    if not again.isEmpty():
        rows = rows.join(again, key, "left_anti").unionByName(rows.join(again, key, "left_semi").dropDuplicates(key))
    met = rows.join(rounds.filter("shard IS NOT NULL"), key)
    words = F.regexp_extract_all(F.col("text"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    parts = F.transform(
        F.col("spans"), lambda s: F.array_join(F.slice(words, (s["from_word"] + 1).cast("int"), (s["to_word"] - s["from_word"]).cast("int")), "")
    )
    whole = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["to_word"] - s["from_word"]) >= F.col("size")
    result = met.withColumn("text", F.when(whole, F.col("text")).otherwise(F.array_join(parts, "")))
    changed = {text_column: F.col("text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return unpacked(result.repartitionByRange("shard", "place").sortWithinPartitions("shard", "place"), docs.columns, **changed)
