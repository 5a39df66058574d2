"""What op4 takes doesn't depend on how the input is split, also where many rows share an id or are equal."""

import random
from collections import Counter

from changeledger.llm import mixing

SCHEMA = "doc_id long, text string, source string"


def taken(spark, rows, parts):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return Counter((r.doc_id, r.source, r.size, r.taken) for r in mixing.mix(docs).collect())


def hot_rows():
    rng = random.Random(3)
    rows = [(rng.choice([7, 7, 7, None, rng.randrange(40)]), "w " * rng.randint(0, 9) + f"t{rng.randrange(200)}", rng.choice("ab")) for _ in range(1500)]
    rows += [(7, "the same row of five", "a")] * 700
    return rows


def test_reruns_agree_under_other_splits(spark):
    rows = hot_rows()
    want = taken(spark, rows, 1)
    random.Random(1).shuffle(rows)
    assert taken(spark, rows, 13) == want == taken(spark, rows[::-1], 5)


def test_targets_are_met_within_half_a_document(spark):
    rows = hot_rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    for source in "ab":
        of = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in of) - of[0].target) <= max(r.size for r in of) / 2
        assert all(r.taken <= 2 * r.size for r in of)


def test_no_step_gathers_a_hot_id(spark):
    """The last window over single rows sees those alone that no step before could tell apart."""
    rows = [(7, f"text {i} " + "w " * (i % 5), "a") for i in range(3000)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    seen, stored = [], mixing.stored

    def counted(df, name, *args):
        out = stored(df, name, *args)
        if name == "op4-cut":
            seen.append(out.count())
        return out

    mixing.stored = counted
    try:
        mixing.mix(docs).count()
    finally:
        mixing.stored = stored
    assert seen[0] == seen[1] == 3000 and seen[2] < 30 and seen[-1] <= 1
