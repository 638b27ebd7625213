"""SimHash fingerprints of documents and the search for near ones.

A term is a pair of neighbouring words (a lone word if there is one only); it weighs as often as it occurs. Every bit of a
term's 64-bit hash votes for or against that bit of the fingerprint. The votes for bits i and i + 32 are counted in the
two halves of one number, so a document needs 32 sums, which Spark adds up where the document is read.

Search: the 64 bits are cut into radius + 2 blocks. Fingerprints within the radius differ in at most ``radius`` blocks, so
they agree on two blocks at least. For every pair of blocks there is a table permuted to have these blocks in front; a
fingerprint is looked up in all of them by equality, and the distance is computed for what is found.
"""

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardsentry.llm.common import frozen, written
from cardsentry.operators.ordering import running_totals

BITS = 64
RADIUS = 3
WORD_BREAK = "[ \\t\\n\\u000b\\f\\r]+"
HALVES = (1 << 32) + 1


def terms(text: Column) -> Column:
    """Pairs of neighbouring words, as an array of structures of two words."""
    words = F.filter(F.split(F.lower(text), WORD_BREAK), lambda w: w != "")
    after = F.slice(words, 2, F.greatest(F.size(words), F.lit(1)))
    return F.when(F.size(words) > 1, F.slice(F.arrays_zip(words.alias("a"), after.alias("b")), 1, F.size(words) - 1)).otherwise(
        F.transform(words, lambda w: F.struct(w.alias("a"), F.lit(None).cast("string").alias("b")))
    )


def fingerprints(texts: DataFrame, key: list[str]) -> DataFrame:
    """(key, fingerprint as a number) of ``texts(key, text)``; keys must be unique. Ties of the votes set no bit, so the
    fingerprint of a text without words is 0, as in the rows that are left out here: join what comes from the left."""
    each = texts.select(*key, F.explode(terms(F.col("text"))).alias("t"))
    hashed = each.select(*key, F.xxhash64("t.a", "t.b").alias("h"))
    sums = [F.sum(F.shiftright("h", i).bitwiseAND(F.lit(HALVES))).alias(f"s{i}") for i in range(32)]
    voted = hashed.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), *sums)
    number = F.lit(0).cast("long")
    for i in range(32):
        low = F.col(f"s{i}").bitwiseAND(F.lit((1 << 32) - 1))
        high = F.shiftrightunsigned(f"s{i}", 32)
        for votes, bit in ((low, i), (high, i + 32)):
            value = (1 << bit) - (1 << 64 if bit == 63 else 0)
            number = number.bitwiseOR(F.when(2 * votes > F.col("n"), F.lit(value)).otherwise(F.lit(0)).cast("long"))
    return voted.select(*key, number.alias("fingerprint"))


def hexadecimal(x: Column) -> Column:
    return F.lower(F.lpad(F.hex(x), 16, "0"))


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def likeness(a: Column, b: Column) -> Column:
    return 1 - distance(a, b) / F.lit(float(BITS))


def within(queries: DataFrame, prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(query, fingerprint, distance): for every fingerprint in ``queries(query)`` all of ``prints(fingerprint)`` within
    ``radius`` bits. Both are distinct numbers, so copies cost nothing and the tables have no hot key but for fingerprints
    that agree on half their bits."""
    blocks = radius + 2
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    mask = lambda i: ((1 << cuts[i + 1]) - (1 << cuts[i])) & ((1 << BITS) - 1)
    signed = lambda m: m - (1 << BITS) if m >> (BITS - 1) else m
    tables = [signed(mask(i) | mask(j)) for i, j in combinations(range(blocks), 2)]

    def keyed(df: DataFrame, column: str) -> DataFrame:
        rows = [F.struct(F.lit(t).alias("table"), F.col(column).bitwiseAND(F.lit(m)).alias("front")) for t, m in enumerate(tables)]
        return df.select(column, F.explode(F.array(*rows)).alias("at")).select(column, "at.*")

    found = keyed(queries, "query").join(keyed(prints, "fingerprint"), ["table", "front"])
    far = distance(F.col("query"), F.col("fingerprint"))
    # the table that counts a pair is the first one on whose blocks the two agree
    same = [F.col("query").bitwiseXOR(F.col("fingerprint")).bitwiseAND(F.lit(m)) == 0 for m in tables]
    first = F.coalesce(*(F.when(s, F.lit(t)) for t, s in enumerate(same)))
    near = found.where((far <= radius) & (first == F.col("table")))
    return near.select("query", "fingerprint", far.alias("distance"))


def neighbours(rows: DataFrame) -> DataFrame:
    """For every distinct ``rows(id, row)`` its place in ascending order and the rows around it in descending order, where
    the first follows the last: (id, row, n_chars, next_id, next_row, prior_id, prior_row, prior_chars)."""
    one = F.lit(1).cast("long").alias("one")
    distinct = rows.groupBy("id", "row").agg(F.max("n_chars").alias("n_chars")).select("*", one)
    ordered = running_totals(distinct, [], [F.col("id"), F.col("row")], sums={"at": "one"})
    ordered = frozen(ordered.select("at", "id", "row", "n_chars"))
    last = ordered.agg(F.max("at")).first()[0] or 0
    below = ordered.select(
        F.when(F.col("at") == last, F.lit(1)).otherwise(F.col("at") + 1).alias("at"),
        F.col("id").alias("next_id"),
        F.col("row").alias("next_row"),
    )
    above = ordered.select(
        F.when(F.col("at") == 1, F.lit(last)).otherwise(F.col("at") - 1).alias("at"),
        F.col("id").alias("prior_id"),
        F.col("row").alias("prior_row"),
        F.col("n_chars").alias("prior_chars"),
    )
    return ordered.join(below, "at").join(above, "at").drop("at")


def with_edits(docs: DataFrame, radius: int = RADIUS, every: int = 50) -> DataFrame:
    """For ``docs(doc_id, text)``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (hexadecimal),
    near_edited, near_next, n_near.

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many, or all, of the next row's
    text; the next row is that of the next smaller doc_id, and the largest for the smallest. Rows of equal ids are in the
    order of a hash of their text, null ids are the smallest; rows equal in id and text are one document. Null texts
    count as empty. n_near is asked for ids divisible by ``every``: how many other documents have a fingerprint within
    ``radius`` bits; null for the rest. An empty table gives an empty one; other columns are ignored.
    """
    key = ["id", "row"]
    text = F.coalesce("text", F.lit(""))
    marked = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"), text.alias("text"))
    marked = marked.withColumn("row", F.xxhash64("text"))
    places = frozen(neighbours(marked.select(*key, F.length("text").cast("long").alias("n_chars"))))
    # one shuffle brings the texts to their places; the part that the row above asks for goes there with a second one
    once = Window.partitionBy(*key).orderBy(F.lit(1))
    full = marked.join(places, key).withColumn("copy", F.row_number().over(once)).where("copy = 1").drop("copy")
    asked = F.floor(F.col("prior_chars") / 2).cast("int")
    heads = full.select(F.col("prior_id").alias("id"), F.col("prior_row").alias("row"), F.substring("text", F.lit(1), asked).alias("head"))
    own = F.substring("text", F.lit(1), (F.col("n_chars") - F.floor(F.col("n_chars") / 2)).cast("int"))
    edited = full.join(heads, key).select(*key, "text", F.concat(own, "head").alias("edited"))
    kinds = F.array(*(F.struct(F.lit(i).alias("kind"), F.col(c).alias("text")) for i, c in enumerate(("text", "edited"))))
    both = edited.select(*key, F.explode(kinds).alias("x")).select(*key, "x.*")
    prints = fingerprints(both, [*key, "kind"])
    of = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("fingerprint")))
    prints = prints.groupBy(*key).agg(of(0).alias("f"), of(1).alias("e"))
    digests = edited.select(*key, F.sha2(F.encode("edited", "utf-8"), 256).alias("edited_sha256"))
    zero = F.lit(0).cast("long")
    rows = digests.join(prints, key, "left").withColumns({c: F.coalesce(c, zero) for c in ("f", "e")})
    rows = written(rows.join(places.select(*key, "n_chars", "next_id", "next_row"), key), "fingerprints")
    after = rows.select(F.col("id").alias("next_id"), F.col("row").alias("next_row"), F.col("f").alias("g"))
    counted = frozen(rows.groupBy("f").agg(F.count(F.lit(1)).alias("n")))
    asks = rows.where(F.col("id") % every == 0).select(F.col("f").alias("query")).distinct()
    close = within(asks, counted.select(F.col("f").alias("fingerprint")), radius)
    close = close.join(counted, close["fingerprint"] == counted["f"]).groupBy("query").agg((F.sum("n") - 1).alias("n_near"))
    out = rows.join(after, ["next_id", "next_row"]).join(close, rows["f"] == close["query"], "left")
    asking = (F.col("id") % every == 0) & (F.col("id") != F.lit(-(1 << 63)))
    return out.select(
        F.when(F.col("id") != F.lit(-(1 << 63)), F.col("id")).alias("doc_id"),
        "n_chars",
        "edited_sha256",
        hexadecimal(F.col("f")).alias("fingerprint"),
        hexadecimal(F.col("e")).alias("edited_fingerprint"),
        likeness(F.col("f"), F.col("e")).alias("near_edited"),
        likeness(F.col("f"), F.col("g")).alias("near_next"),
        F.when(asking, F.col("n_near")).alias("n_near"),
    )
