"""Document fingerprints: invertible Bloom lookup sketches of paragraphs, in SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A paragraph is a line; longer ones are cut at sentence ends and after this many characters.
PARAGRAPH_CHARS = 160
#: A sketch has three parts of so many cells, taken from bits of a digest; a digest lies in one cell of each.
PARTS = 3
SMALL, LARGE = (3, 0), (5, 15)
#: Digests of both versions that one sketch of the larger layout is to hold on average.
DIGESTS_EACH = 12
#: Rounds of peeling, each of which takes out all cells of a single digest.
ROUNDS = 6


def paragraph_digests(text: Column) -> Column:
    """Distinct 64-bit digests of a text's paragraphs, white space around them aside."""
    parts = F.regexp_extract_all(text, F.lit(rf"[^\n.!?]{{1,{PARAGRAPH_CHARS}}}[.!?]*|[.!?]+"), F.lit(0))
    full = F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: p != "")
    return F.array_distinct(F.transform(full, lambda p: F.xxhash64(p)))


def _in_cell(digest: str, part: int, cell: str, bits: tuple[int, int]) -> str:
    """Whether a digest lies in a cell of a part; ``bits`` are how many choose the cell and the first of them."""
    return f"(shiftright({digest}, {bits[1] + bits[0] * part}) & {(1 << bits[0]) - 1}) = {cell}"


def _sketch(digests: str, bits: tuple[int, int] = SMALL) -> str:
    """Cells of a list of digests: how many, and the exclusive or of them and of their check digests."""
    last = (1 << bits[0]) - 1
    parts = [f"transform(sequence(0, {last}), i -> filter({digests}, d -> {_in_cell('d', p, 'i', bits)}))" for p in range(PARTS)]
    return f"""transform(
        concat({", ".join(parts)}),
        own -> named_struct(
            'n', size(own),
            'd', aggregate(own, 0L, (x, d) -> x ^ d),
            'c', aggregate(own, 0L, (x, d) -> x ^ xxhash64(d))))"""


def _difference(a: str, b: str, bits: tuple[int, int] = SMALL) -> str:
    """How many digests differ between two sketches, by peeling; null if that does not empty the cells."""
    cells = 1 << bits[0]
    subtracted = f"zip_with({a}, {b}, (x, y) -> named_struct('n', x.n - y.n, 'd', x.d ^ y.d, 'c', x.c ^ y.c))"
    single = "array_distinct(filter(state.cells, x -> abs(x.n) = 1 AND x.c = xxhash64(x.d)))"
    parts = [
        f"""transform(slice(state.cells, {p * cells + 1}, {cells}), (x, i) -> if(x.d = 0 AND x.n = 0, x, aggregate(
            filter(taken, t -> {_in_cell("t.d", p, "i", bits)}), x,
            (rest, t) -> named_struct('n', rest.n - t.n, 'd', rest.d ^ t.d, 'c', rest.c ^ t.c))))"""
        for p in range(PARTS)
    ]
    peeled = f"""aggregate(sequence(1, {ROUNDS}), named_struct('cells', {subtracted}, 'found', 0),
        (state, round) -> transform(array({single}), taken ->
            if(size(taken) = 0, state, named_struct('cells', concat({", ".join(parts)}), 'found', state.found + size(taken))))[0])"""
    empty = "forall(done.cells, x -> x.n = 0 AND x.d = 0 AND x.c = 0)"
    return f"transform(array({peeled}), done -> if({empty}, done.found, NULL))[0]"


def _counted(a: str, b: str) -> str:
    return f"size(array_except({a}, {b})) + size(array_except({b}, {a}))"


def _difference_of_shares(a: str, b: str) -> str:
    """The same over as many sketches as the digests need, each of those with equal bits.

    A sketch that does not peel is made anew with more cells from other bits;
    should that fail too, the lists of its share are compared.
    """
    side = f"int(ceil(sqrt((size({a}) + size({b})) / {DIGESTS_EACH}.0)))"

    def shares(of_a: str, of_b: str, bits: int) -> str:
        one, other = (f"filter({x}, d -> pmod(shiftright(d, {bits}), side) = k)" for x in (of_a, of_b))
        return f"transform(sequence(0, side - 1), k -> named_struct('a', {one}, 'b', {other}))"

    tries = [_difference(_sketch("h.a", bits), _sketch("h.b", bits), bits) for bits in (SMALL, LARGE)]
    own = f"transform({shares('g.a', 'g.b', 45)}, h -> coalesce({', '.join(tries)}, {_counted('h.a', 'h.b')}))"
    found = f"flatten(transform({shares(a, b, 30)}, g -> {own}))"
    return f"transform(array({side}), side -> aggregate({found}, 0, (x, n) -> x + n))[0]"


def difference(a: str, b: str, sketch_a: str, sketch_b: str) -> Column:
    """Digests in one of the columns ``a`` and ``b`` only.

    Peeled from the difference of the two sketches; where that fails, from a
    larger layout of as many sketches as the digests need.
    """
    return F.expr(f"if(size({a}) + size({b}) = 0, 0, coalesce({_difference(sketch_a, sketch_b)}, {_difference_of_shares(a, b)}))")


def _written(sketch: str) -> Column:
    return F.expr(f"concat_ws('-', transform({sketch}, x -> concat(x.n, '.', lower(hex(x.d)))))")


def _likeness(differing: str, a: str, b: str) -> Column:
    both = F.size(a) + F.size(b)
    return F.when(both == 0, 1.0).otherwise(1 - F.col(differing) / both)


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, digests, next_text, next_digests): each row with its follower in descending id.

    After the last row comes the first. Null ids come last, equal ids in
    descending text. Rows meet in ranges of ids between quantiles, each with
    the first row of the next range behind it, so no window sees the table.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / ranges for i in range(1, ranges)]
    cuts = sorted(set(rows.agg(F.percentile_approx("id", shares, 100 * ranges).alias("cuts")).first()["cuts"] or []))
    above = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c >= F.col("id"))) if cuts else F.lit(0)
    rows = rows.withColumn("range", F.when(F.col("id").isNull(), len(cuts) + 1).otherwise(above))
    filled = sorted(r["range"] for r in rows.select("range").distinct().collect())  # bounded by the quantiles

    firsts = rows.groupBy("range").agg(F.max(F.struct("id", "text")).alias("first"))
    before = [F.lit(x) for own, last in zip(filled, [filled[-1:], *[[f] for f in filled]]) for x in (own, last[0])]
    behind = F.create_map(*before)[F.col("range")] if before else F.lit(0)
    behind = firsts.select("first.id", "first.text", behind.alias("range"), F.lit(True).alias("behind"))
    every = rows.withColumn("behind", F.lit(False)).unionByName(behind).withColumn("digests", paragraph_digests(F.col("text")))
    order = Window.partitionBy("range").orderBy("behind", F.desc_nulls_last("id"), F.desc("text"))
    return every.select(
        "id", "text", "digests", "behind", F.lead("text").over(order).alias("next_text"), F.lead("digests").over(order).alias("next_digests")
    ).where(~F.col("behind"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, fingerprint) per row: the cells of the text's sketch, written out.

    Texts of the same set of paragraphs have the same fingerprint; a null text
    counts as empty, whose cells are all 0.
    """
    digests = paragraph_digests(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return docs.select(F.col(id_col).alias("id"), digests.alias("digests")).select(
        F.col("id").alias(id_col), _written(_sketch("digests")).alias("fingerprint")
    )


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's fingerprint, and how like it is to that of its edited text and of the next row.

    The edited text has its last floor(n / 2) code points replaced by the first
    as many of the next row's text (all, if that is shorter). Likeness is 1
    less the share of both versions' paragraphs that only one of them has:
    1 for equal sets, two empty ones too, and 0 for sets without a common one.
    Null texts count as empty; null ids and repeated rows stay. A single row is
    its own next.
    """
    rows = with_next(docs, id_col, text_col).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.select("id", "n_chars", "digests", "next_digests", edited.alias("edited"))
    rows = rows.select("id", "n_chars", "digests", "next_digests", F.sha2("edited", 256).alias("edited_sha256"), paragraph_digests(F.col("edited")).alias("edited_digests"))
    kinds = ["", "edited_", "next_"]
    rows = rows.select("*", *[F.expr(_sketch(f"{k}digests")).alias(f"{k}sketch") for k in kinds])
    rows = rows.select(
        "*", *[difference("digests", f"{k}digests", "sketch", f"{k}sketch").alias(f"{k}differing") for k in kinds[1:]]
    )
    return rows.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256",
        _written("sketch").alias("fingerprint"), _written("edited_sketch").alias("edited_fingerprint"),
        _likeness("edited_differing", "digests", "edited_digests").alias("near_edited"),
        _likeness("next_differing", "digests", "next_digests").alias("near_next"),
    )
