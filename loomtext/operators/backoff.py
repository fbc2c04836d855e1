"""Held-out loss of a back-off n-gram model: modified Kneser-Ney smoothing (Chen and Goodman 1999) as a chain of equi-joins.

The highest order counts n-grams; every lower one counts in how many different contexts a shorter one stood. Each order discounts its counts, and what it saves in
a context goes to the next lower order, down to equal shares of the vocabulary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.session import written

#: Discount of a count of 1, 2, or 3 or more where too few n-grams have the counts it is estimated from.
FALLBACK = 0.75


def words_at(first: int, last: int) -> list[str]:
    return [f"w{i}" for i in range(first, last + 1)]


def ngrams_of(rows: DataFrame, n: int, *keep: str) -> DataFrame:
    """``(keep, w1..wn)``: every run of ``n`` ids of each ``input_ids``; runs never cross a row, shorter rows have none.

    Only places are listed; the ids are taken from the array where they stand.
    """
    ids = F.col("input_ids")
    places = F.when(F.size(ids) >= n, F.sequence(F.lit(0), F.size(ids) - n))
    each = rows.select(*keep, "input_ids", F.explode_outer(places).alias("_at")).where(F.col("_at").isNotNull())
    return each.select(*keep, *[F.get(ids, F.col("_at") + i).alias(f"w{i + 1}") for i in range(n)])


def order_tables(counts: DataFrame, n: int) -> dict[int, DataFrame]:
    """``(w1..wk, c)`` for k from n to 1: counts, below n the number of different words before. Each lower order is written once, as the next one and the joins read it."""
    tables = {n: counts}
    for k in range(n - 1, 0, -1):
        shorter = [F.col(f"w{i + 1}").alias(f"w{i}") for i in range(1, k + 1)]
        tables[k] = written(tables[k + 1].groupBy(*shorter).agg(F.count("*").alias("c")), f"order{k}")
    return tables


def discounts(table: DataFrame) -> tuple[float, float, float]:
    """The discounts of counts 1, 2 and 3 or more, from how many n-grams have the counts 1 to 4."""
    n1, n2, n3, n4 = table.agg(*[F.count_if(F.col("c") == i).alias(f"n{i}") for i in range(1, 5)]).first()
    share = n1 / (n1 + 2 * n2) if n1 + n2 else None
    found = []
    for k, (here, after) in enumerate(((n1, n2), (n2, n3), (n3, n4)), start=1):
        value = k - (k + 1) * share * after / here if here and share is not None else 0.0
        found.append(value if value > 0 else FALLBACK)  # without a discount an unseen word would have no share
    return found[0], found[1], found[2]


def _discount(c: Column, values: tuple[float, float, float]) -> Column:
    return F.when(c == 1, values[0]).when(c == 2, values[1]).otherwise(values[2])


def backoff_loss(blocks: DataFrame, vocab_size: int, n: int = 3) -> DataFrame:
    """``(ngrams, cross_entropy, perplexity)`` of a model of order ``n`` counted on ``train`` rows and read on ``test`` rows of ``split``.

    One grouping counts both sides and is written once: every order, its discounts and its contexts read that table. A frequent n-gram is one row per task
    before every shuffle, and each join has a side with unique keys, so Spark may split a frequent context. What an asked n-gram of the highest order counts
    stands in its own row; only the lower orders are joined. Contexts that training has not seen leave the word to the lower order. Without test n-grams the loss is null.
    """
    names = words_at(1, n)
    sided = blocks.select((F.col("split") == "train").alias("_train"), (F.col("split") == "test").alias("_test"), "input_ids")
    counted = ngrams_of(sided, n, "_train", "_test").groupBy(*names).agg(F.count_if("_train").alias("c"), F.count_if("_test").alias("asked"))
    both = written(counted, "ngrams")
    tables = order_tables(both.where("c > 0").select(*names, "c"), n)
    asked = both.where("asked > 0").select(*names, F.col("c").alias("_own"), "asked").withColumn("p", F.lit(1.0 / vocab_size))
    for k in range(1, n + 1):
        table, values, mine = tables[k], discounts(tables[k]), words_at(n - k + 1, n)
        if k == n:
            joined = asked.withColumn("_kept", F.when(F.col("_own") > 0, F.col("_own") - _discount(F.col("_own"), values)))
        else:
            seen = table.select(*[F.col(f"w{i + 1}").alias(name) for i, name in enumerate(mine)], (F.col("c") - _discount(F.col("c"), values)).alias("_kept"))
            joined = asked.join(seen, mine, "left")
        # How many n-grams of a context have each discount: whole numbers, so no order of addition changes them.
        levels = [F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2), F.count_if(F.col("c") > 2)]
        saved = sum((n_k * F.lit(value) for n_k, value in zip(levels, values, strict=True)), F.lit(0.0))
        sums = [F.sum("c").cast("double").alias("_total"), saved.alias("_saved")]
        if k == 1:
            total, saved = table.agg(*sums).first()
            joined = joined.withColumn("_total", F.lit(total).cast("double")).withColumn("_saved", F.lit(saved).cast("double"))
        else:
            contexts = table.groupBy(*[F.col(f"w{i + 1}").alias(name) for i, name in enumerate(mine[:-1])]).agg(*sums)
            joined = joined.join(contexts, mine[:-1], "left")
        p = (F.coalesce("_kept", F.lit(0.0)) + F.col("_saved") * F.col("p")) / F.col("_total")
        asked = joined.withColumn("p", F.when(F.col("_total") > 0, p).otherwise(F.col("p"))).drop("_kept", "_total", "_saved")
    loss = asked.agg(
        F.coalesce(F.sum("asked"), F.lit(0)).cast("bigint").alias("ngrams"), (F.sum(-F.col("asked") * F.log("p")) / F.sum("asked")).alias("cross_entropy")
    )
    return loss.withColumn("perplexity", F.exp("cross_entropy"))
