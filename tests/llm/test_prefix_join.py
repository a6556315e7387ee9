import random

from pyspark.sql import functions as F

from folioworks.llm import prefix_join


def similar(rows, percent=80):
    return {(a, b) for a, ac, x in rows for b, bc, y in rows if a < b and ac != bc and 100 * len(set(x) & set(y)) >= percent * len(set(x) | set(y))}


def test_texts_of_one_template_make_few_pairs(spark):
    """Sets of similarity 0.67 without elements of their own, and three copies of one with small changes."""
    rng = random.Random(5)
    pool = rng.sample(range(1 << 52), 140)
    sets = [sorted(rng.sample(pool, 112)) for _ in range(80)]
    sets += [sets[7][3:], sets[7][:-9], [*sets[7][5:], *range(8)]]
    rows = [(i, i, s) for i, s in enumerate(sets)]
    df = spark.createDataFrame(rows, "key bigint, c bigint, elements array<bigint>").repartition(3)
    got, near = {tuple(r) for r in prefix_join.candidates(df, 80).collect()}, similar(rows)
    assert near and near <= got and len(got) < len(near) + len(sets) // 4


def test_many_elements_do_not_bring_common_ones_into_prefixes(spark, monkeypatch):
    """2.2 million elements: what three sets share comes after 230 that each has alone, so no two sets meet."""
    met, write = [], prefix_join.materialize

    def counted(df):
        made = write(df)
        if "other" in made.columns:
            met.append(made.count())
        return made

    monkeypatch.setattr(prefix_join, "materialize", counted)
    own = F.transform(F.sequence(F.lit(0), F.lit(229)), lambda i: F.xxhash64("id", i))
    common = F.transform(F.sequence(F.lit(1000), F.lit(1869)), lambda i: F.xxhash64(F.expr("id div 3"), i))
    df = spark.range(2000).select(F.col("id").alias("key"), F.col("id").alias("c"), F.concat(own, common).alias("elements"))
    assert prefix_join.candidates(df, 80).count() == 0
    assert met == [0]


def test_odd_percents_sizes_and_shared_components(spark):
    """Small and unequal sets, elements held by one component alone, and long sets whose map is full."""
    rng = random.Random(8)
    long = rng.sample(range(1 << 52), 6000)
    sets = [long, long[300:], [*long[700:], *range(200)], long[1400:], list(range(4)), list(range(5)), [0, 1, 2, 9], list(range(100, 125)), list(range(100, 120)), list(range(-10, 30))]
    for _ in range(40):
        sets.append(sorted({x for x in range(30) if rng.random() < 0.85} | {1000 + rng.randrange(50)}))
    rows = [(i, i if i % 4 else 0, s) for i, s in enumerate(sets)]
    df = spark.createDataFrame(rows, "key bigint, c bigint, elements array<bigint>").repartition(3)
    for percent in (80, 67, 95, 100):
        got, near = {tuple(r) for r in prefix_join.candidates(df, percent).collect()}, similar(rows, percent)
        assert near <= got and all(a < b and rows[a][1] != rows[b][1] for a, b in got)
    assert similar(rows) and not prefix_join.candidates(df.limit(0), 80).count()
