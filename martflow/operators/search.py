"""Search-style operators on document tables.

Relevance (G5) is BM25 computed as a DataFrame job: corpus statistics
(document count, mean field length, per-term document frequency) are
one aggregate over the corpus - the per-term counts only for the query's
few terms - and each match is scored by JVM expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.functions import text

# BM25 parameters (the usual defaults of search engines).
BM25_K1, BM25_B = 1.2, 0.75


def page(df: DataFrame, keys: list, page_no: int = 1, page_size: int = 20) -> DataFrame:
    """G1 + G2: rows ``(page_no-1)*page_size`` .. ``+page_size`` in ``keys``
    order.  Planned as a per-task top-(from+size) and a merge."""
    start = (max(page_no, 1) - 1) * page_size
    ordered = df.orderBy(*keys)
    return (ordered.offset(start) if start else ordered).limit(page_size)


PARTS = 200             # ranges that a step of the search for a rank counts
SORTED_ROWS = 50_000    # rows among which a page is found by sorting


def page_by_rank(df: DataFrame, keys: list[tuple[str, bool]], page_no: int = 1, page_size: int = 20,
                 parts: int = PARTS, sorted_rows: int = SORTED_ROWS) -> DataFrame:
    """G1 + G2 for deep pages: the rows of :func:`page` by ``keys`` (numbers; column, descending).

    :func:`page` moves from+size rows out of every task.  Here quantiles of the first key cut
    its values into ranges, the rows of each are counted, and only the range that holds
    ``from`` goes on, until it has at most ``sorted_rows``; so a step returns some hundred
    counts, and no rows are moved but those.  A quantile itself is a range of its own, and
    where one value (a hot score) has more rows than that, the next key cuts them.  What the
    page needs from later ranges is a plain top.  Nulls come where ``orderBy`` puts them; rows
    equal in all keys come in any order.  Each step runs two jobs while the plan is built.
    """
    start, order = (max(page_no, 1) - 1) * page_size, [F.desc(k) if down else F.asc(k) for k, down in keys]
    rest, todo, later = df, list(keys), []
    while todo:
        key, down = todo[0]
        cuts, n = rest.agg(F.percentile_approx(key, [(i + 1) / parts for i in range(parts)]), F.count(F.lit(1))).first()
        if start >= n:
            return df.where(F.lit(False))
        if n <= sorted_rows:
            break
        bounds = sorted({b for b in cuts or [] if b == b})
        # range 2i + 1 is bound i itself, range 2i what is between it and the one before; -1: nulls
        values = F.array(*[F.lit(b) for b in bounds]) if bounds else F.array().cast("array<double>")
        place = F.when(F.col(key).isNull(), -1).otherwise(
            2 * F.size(F.filter(values, lambda b: b < F.col(key))) + F.array_contains(values, F.col(key)).cast("int"))
        counts = rest.groupBy(place.alias("i")).agg(F.count(F.lit(1)).alias("n")).collect()
        counts = sorted(((r["i"], r["n"]) for r in counts), reverse=down)
        for at, size in counts:
            if start < size:
                break
            start -= size
        if start + page_size > size and at != counts[-1][0]:
            later.append(rest.where(place < at if down else place > at))
        k = at // 2
        if at < 0:
            mine = F.col(key).isNull()
        elif at % 2:
            mine = F.col(key) == F.lit(bounds[k])
        else:
            mine = F.col(key).isNotNull()
            if k > 0:
                above = F.col(key) > F.lit(bounds[k - 1])
                # NaN is above all numbers, which the statistics of a cached table don't tell
                mine = mine & (above | F.isnan(key) if rest.schema[key].dataType.typeName() in ("double", "float") else above)
            if k < len(bounds):
                mine = mine & (F.col(key) < F.lit(bounds[k]))
        rest = rest.where(mine)
        if at % 2:              # one value, or null
            todo.pop(0)
        elif size == n:         # values too near each other to be told apart by quantiles
            break
    found = rest.orderBy(*order).offset(start).limit(page_size)
    for more in later:
        found = found.unionByName(more.orderBy(*order).limit(page_size))
    return found.orderBy(*order).limit(page_size) if later else found


def bm25(docs: DataFrame, text_col: str, q: str, weight: str) -> DataFrame:
    """Add ``score`` = BM25 of ``text_col`` for the query ``q``.

    ``docs`` has one row per distinct document, and ``weight`` how many times
    the corpus holds it (order lines of a product, say), so texts are
    tokenized once each and the corpus statistics are weighted sums.
    Document count, mean length and the document frequency of each query term
    come from one aggregate, folded into one row; a single scalar subquery
    carries them into the scoring expression.
    """
    qt = text.query_tokens(q)
    toks = text.tokens(text_col)
    # Each document gives a row with a null term (its length) and a row per
    # query term it contains.  Grouped by term (at most one group per query
    # term plus one), the null group holds the document count and the length,
    # the others the document frequencies.
    hits = F.coalesce(F.array_intersect(F.array_distinct(toks), qt), F.array().cast("array<string>"))
    per_doc = docs.select(F.col(weight).alias("_w"), F.size(toks).alias("_len"),
                          F.explode(F.concat(F.array(F.lit(None).cast("string")), hits)).alias("term"))
    groups = per_doc.groupBy("term").agg(F.sum("_w").alias("n"), F.sum(F.col("_w") * F.col("_len")).alias("length"))
    is_all = F.col("term").isNull()
    stats = groups.agg(
        F.coalesce(F.max(F.when(is_all, F.col("n"))), F.lit(0)).alias("n_docs"),
        F.max(F.when(is_all, F.col("length") / F.col("n"))).alias("avgdl"),
        F.map_from_entries(F.collect_list(F.when(~is_all, F.struct("term", "n")))).alias("m"))
    # The statistics enter as one struct column (a scalar subquery,
    # computed once); a subquery may not appear inside the scoring lambda.
    scored = docs.withColumn("_st", stats.select(F.struct("n_docs", "avgdl", "m")).scalar())
    n_docs, avgdl, df_map = F.col("_st.n_docs"), F.col("_st.avgdl"), F.col("_st.m")
    dl = F.size(toks)

    def term_score(acc, t):
        tf = F.size(F.filter(toks, lambda x: x == t)).cast("double")
        n = F.coalesce(F.element_at(df_map, t), F.lit(0)).cast("double")
        idf = F.log(F.lit(1.0) + (n_docs - n + 0.5) / (n + 0.5))
        norm = tf + F.lit(BM25_K1) * (F.lit(1 - BM25_B) + F.lit(BM25_B) * dl / avgdl)
        return acc + idf * tf * F.lit(BM25_K1 + 1) / norm

    score = F.aggregate(qt, F.lit(0.0).cast("double"), term_score)
    return scored.withColumn("score", score).drop("_st")
