"""SimHash fingerprints of documents, and all fingerprints within a Hamming radius.

A term is a word with its follower; it weighs more the longer it is, as long pairs are rarer. Each
bit of a term's hash votes with the term's weight, and a bit of the fingerprint is set where the
votes for it win. Votes are counted as sums of masked hashes, two bits in the halves of one number.

The 64 bits are cut into blocks. Two fingerprints at most ``radius`` bits apart agree in all but
``radius`` of the blocks at least; so there is one table for each choice of that many blocks, which
are permuted to the front and make its key. Whoever shares a key is verified by the whole distance.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import small, stored, text_key
from starmart.operators import add_id

# Words are cut into parts of at most 16 characters, so that text without spaces has terms too.
WORD = r"[^\x20\x09-\x0D]{1,16}"
MOST_WEIGHT = 8
BITS = 64
HALF = BITS // 2
LOW = (1 << HALF) - 1
PAIR = (1 << HALF) + 1
RADIUS = 3
BLOCKS = 5
# Documents whose id is divisible by this are looked up among all.
QUERY_STEP = 20


def votes(texts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``fp`` (64 bits as bigint) for each row of ``texts(*keys, body)``.

    Every row has other ``keys``. A text without words has fingerprint zero. Rows of a text are summed
    where they are made: a text of any length leaves one row of sums per task.
    """
    words = texts.select(*keys, F.regexp_extract_all("body", F.lit(WORD), F.lit(0)).alias("words"))
    followers = F.slice("words", F.lit(2), F.greatest(F.size("words"), F.lit(1)))
    terms = words.select(*keys, F.explode_outer(F.arrays_zip(F.col("words").alias("a"), followers.alias("b"))).alias("t"))
    hashed = terms.select(
        *keys,
        F.xxhash64("t.a", "t.b").alias("h"),
        F.when(F.col("t.a").isNull(), 0)
        .otherwise(F.least(F.lit(MOST_WEIGHT), 1 + F.floor((F.length("t.a") + F.coalesce(F.length("t.b"), F.lit(0))) / 4)))
        .cast("bigint")
        .alias("w"),
    )
    lanes = [
        F.sum(F.shiftrightunsigned("h", s).bitwiseAND(F.lit(PAIR)) * F.col("w")).alias(f"v{s}") for s in range(HALF)
    ]
    summed = hashed.groupBy(*keys).agg(F.sum("w").alias("total"), *lanes)

    def bit(n: int) -> Column:
        lane = F.col(f"v{n % HALF}")
        half = lane.bitwiseAND(F.lit(LOW)) if n < HALF else F.shiftrightunsigned(lane, HALF)
        return F.when(half * 2 > F.col("total"), F.lit(1 << n if n < BITS - 1 else -(1 << n))).otherwise(F.lit(0)).cast("bigint")

    return summed.select(*keys, reduce(Column.bitwiseOR, [bit(n) for n in range(BITS)]).alias("fp"))


def digits(fp: Column) -> Column:
    """16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def likeness(a: Column, b: Column) -> Column:
    """The share of equal bits, from 0 to 1."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text_key`` and ``fp`` of each distinct pair of id and text; null counts as empty."""
    rows = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), F.coalesce("text", F.lit("")).alias("body"))
    return votes(rows, ["doc_id", "text_key"])


def _key(choice: tuple[int, ...], blocks: int) -> Column:
    """The bits of the chosen blocks, moved to the front of one number."""
    ends = [BITS * k // blocks for k in range(blocks + 1)]
    out = F.lit(0).cast("bigint")
    for k in choice:
        width = ends[k + 1] - ends[k]
        mask = (1 << width) - 1 if width < BITS else -1
        block = F.shiftrightunsigned("fp", ends[k]).bitwiseAND(F.lit(mask))
        out = F.shiftleft(out, width).bitwiseOR(block)
    return out


def block_tables(fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """``table``, ``key`` and all columns of ``fps`` for every permuted table."""
    if not 0 <= radius < blocks <= BITS:
        raise ValueError("more blocks than bits of the radius are needed, at most one for each bit")
    places = [F.struct(F.lit(n).alias("table"), _key(c, blocks).alias("key")) for n, c in enumerate(combinations(range(blocks), blocks - radius))]
    return fps.select("*", F.explode(F.array(*places)).alias("place")).select("place.*", *fps.columns)


def within(queries: DataFrame, fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """``query`` and ``fp`` for every fingerprint of ``fps(fp)`` at most ``radius`` bits from one of
    ``queries(fp)``, each pair once. Both sides hold distinct fingerprints.

    Exact for every radius. More ``blocks`` make more tables with longer keys, so that fewer
    fingerprints share a place: with radius 3, 5 blocks make 10 tables with keys of 25 bits and 7
    blocks 35 tables with 36 bits, for more than some 10^8 fingerprints.
    """
    # Written, so that the join has nothing but shuffles below it and a crowded place is split.
    tables = stored(block_tables(fps.select("fp"), radius, blocks), "block-tables")
    probes = stored(block_tables(queries.select("fp"), radius, blocks), "block-probes").withColumnRenamed("fp", "query")
    near = F.bit_count(F.col("query").bitwiseXOR(F.col("fp"))) <= radius
    met = probes.join(tables, (probes["table"] == tables["table"]) & (probes["key"] == tables["key"]) & near)
    return met.select("query", "fp").distinct()


def _entries(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``entries(own, doc_id, n_chars, n, rank)``, one per distinct pair of id and text in ascending order
    (null ids last, then by a hash of the text), and ``texts(own, text)`` of them."""
    key = text_key(F.col("text"))
    own = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), key)
    rows = docs.select(own.alias("own"), "doc_id", key.alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    counted = rows.select("own", "doc_id", "key", F.length("text").alias("length")).groupBy("own", "doc_id", "key").agg(
        F.max("length").cast("bigint").alias("n_chars"), F.count(F.lit(1)).alias("n")
    )
    ordered = counted.withColumn("last", F.col("doc_id").isNull())
    ranked = add_id(ordered, "sequence", "rank", start=0, order_by=["last", "doc_id", "key"])
    entries = stored(ranked.select("own", "doc_id", "n_chars", "n", "rank"), "entries")
    texts = rows.select("own", "text")
    repeated = entries.filter("n > 1").select(F.col("own").alias("other"))
    if not repeated.isEmpty():
        same = F.col("own") == F.col("other")
        once = texts.join(small(repeated), same, "left_semi").dropDuplicates(["own"])
        texts = texts.join(small(repeated), same, "left_anti").unionByName(once)
    return entries, texts


def edited_fingerprints(docs: DataFrame, radius: int = RADIUS, step: int = QUERY_STEP) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next`` and ``n_within``.

    The edited text has its last quarter (rounded down, in characters) replaced by the first as many of
    the next document, or all it has. Documents are taken by ascending id, null ids last, rows of one id by
    a hash of the text; after the last comes the first, and a row repeated as a whole is followed by its
    copy. ``n_within`` counts the other rows within ``radius`` bits of a document whose id is divisible by
    ``step``; it is null for the others. Null texts count as empty and have fingerprint zero. An empty
    table gives no rows; other columns are ignored.

    A text is shuffled once and read twice, and its followers' first quarters once.
    """
    entries, texts = _entries(docs)
    total = entries.count()
    after = F.pmod(F.col("rank") - 1, F.lit(max(total, 1)))
    follower = entries.select(F.col("own").alias("next"), after.alias("before"))
    led = entries.join(follower, F.col("rank") == F.col("before")).select("own", "doc_id", "n_chars", "n", "next")
    # The last copy of a repeated row is followed by the next document, the others by a copy.
    follows = F.array(
        F.struct(F.lit(0).alias("kind"), F.col("next"), F.lit(1).cast("bigint").alias("rows")),
        F.struct(F.lit(1).alias("kind"), F.col("own").alias("next"), (F.col("n") - 1).alias("rows")),
    )
    takers = led.select("own", "doc_id", "n_chars", F.explode(follows).alias("f")).select("own", "doc_id", "n_chars", "f.*")
    takers = stored(takers.filter("rows > 0"), "takers")
    take = F.floor(F.col("n_chars") / 4).cast("int")
    wanted = takers.select("next", F.col("own").alias("taker"), "kind", "n_chars", take.alias("take"))
    heads = texts.join(wanted, F.col("own") == F.col("next")).select(
        "taker", "kind", "n_chars", "take", F.substring(F.col("text"), F.lit(1), F.col("take")).alias("head")
    )
    met = texts.join(heads, F.col("own") == F.col("taker"))
    kept = F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - F.col("take")).cast("int"))
    both = met.select("own", "kind", "text", F.concat(kept, "head").alias("edited"))
    versions = F.array(
        F.struct(F.lit(0).alias("version"), F.col("text").alias("body")),
        F.struct(F.lit(1).alias("version"), F.col("edited").alias("body")),
    )
    each = both.select("own", "kind", F.sha2("edited", 256).alias("sha"), F.explode(versions).alias("v"))
    voted = votes(each.select("own", "kind", "sha", "v.*"), ["own", "kind", "sha", "version"])
    pair = voted.groupBy("own", "kind", "sha").agg(
        F.max(F.when(F.col("version") == 0, F.col("fp"))).alias("fp"), F.max(F.when(F.col("version") == 1, F.col("fp"))).alias("edited_fp")
    )
    found = stored(pair.select("own", "kind", F.col("sha").alias("edited_sha256"), "fp", "edited_fp"), "edited-fingerprints")

    known = found.filter("kind = 0").select(F.col("own").alias("next"), F.col("fp").alias("next_fp"))
    taken = takers.join(found, ["own", "kind"]).join(known, "next")
    taken = stored(taken, "compared")
    counted = taken.groupBy("fp").agg(F.sum("rows").alias("members"))
    counted = stored(counted, "distinct-fingerprints")
    asked = taken.filter(F.col("doc_id") % step == 0).select("fp").distinct()
    near = within(asked, counted, radius).join(counted, "fp")
    sizes = stored(near.groupBy("query").agg((F.sum("members") - 1).alias("n_within")), "sizes")
    out = taken.join(sizes, F.col("fp") == F.col("query"), "left")
    return out.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        digits(F.col("fp")).alias("fingerprint"),
        digits(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        F.when(F.col("doc_id") % step == 0, F.col("n_within")).alias("n_within"),
        F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("copy"),
    ).drop("copy")
