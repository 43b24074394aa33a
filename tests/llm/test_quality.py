import random

from tests.conftest import rows as collected

from stallbook.llm import quality

from .conftest import awkward


def prose(rng, n, low=3, high=8):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(low, high))) for _ in range(n))


def test_limits_follow_language_and_source(documents):
    rng = random.Random(1)
    rows = [(i, prose(rng, 80), "en", "a") for i in range(250)]
    rows += [(1000 + i, prose(rng, 80, 9, 16), "de", "b") for i in range(250)]
    rows += [(2000, prose(rng, 80, 9, 16), "en", "a"), (2001, prose(rng, 80), "de", "b"), (2002, prose(rng, 80, 9, 16), "de", "a")]
    rows += [(2003, prose(rng, 80).replace(" ", "### "), "en", "a"), (2004, "word " * 80, "en", "a"), (2005, prose(rng, 9), "en", "a")]
    found = {r["doc_id"]: r for r in collected(quality.assessed(documents(rows)))}
    assert all(found[i]["kept"] for i, *_ in rows[:500])
    assert not found[2000]["kept"] and not found[2001]["kept"] and not found[2003]["kept"]
    assert found[2002]["kept"]  # a small group goes by its language
    assert found[2004]["base_failed"] and found[2005]["base_failed"] and not found[2003]["base_failed"]


def test_buckets_are_close_below(spark):
    frame = spark.range(0, 70_000, 7).selectExpr("id as v")
    bucket = quality._bucket(frame["v"])
    got = frame.select("v", bucket.alias("b"), quality._floor(bucket).alias("low")).collect()
    assert all(r["low"] <= r["v"] and (r["v"] - r["low"]) * 64 <= r["v"] for r in got)
    assert [r["b"] for r in got] == sorted(r["b"] for r in got)


def test_merged_sketches_equal_the_sketch_of_all(documents):
    rng = random.Random(2)
    rows = [(i, prose(rng, 60), "en", rng.choice("abc")) for i in range(300)]
    frame = quality.counted(documents(rows), ("lang", "source"))
    sketch = quality.sketches(frame, quality.RULES, ("lang", "source"))
    merged = quality._fences(sketch, ())
    whole = quality._fences(quality.sketches(frame.selectExpr("'x' as lang", "'y' as source", *quality.COUNTS), quality.RULES, ("lang", "source")), ())
    assert collected(merged, "rule") == collected(whole, "rule")


def test_limits_on_rare_values_follow_the_corpus(documents):
    """Texts of one source repeat lines now and then, those of the other never: the same text passes in one only."""
    rng = random.Random(9)

    def text(repeats):
        own = [prose(rng, 20) for _ in range(40)]
        return "\n".join(own + own[:repeats])

    rows = [(i, text(rng.choice([0, 0, 0, 1, 2, 3])), "en", "a") for i in range(300)]
    rows += [(1000 + i, text(0), "en", "b") for i in range(300)]
    one = text(3)
    rows += [(2000, one, "en", "a"), (2001, one, "en", "b")]
    frame = documents(rows)
    found = {r["doc_id"]: r["kept"] for r in collected(quality.assessed(frame))}
    assert found[2000] and not found[2001]
    limits = {r["source"]: r for r in quality.thresholds(quality.counted(frame, ("doc_id", "lang", "source"))).collect()}
    assert limits["a"]["repeated_lines_to"] > 60 > limits["b"]["repeated_lines_to"]
    assert limits["a"]["repeated_words_to"] > limits["b"]["repeated_words_to"]
    assert sum(not found[i] for i in range(300)) <= 3


def test_awkward_rows(documents):
    found = collected(quality.assessed(documents(awkward())), "doc_id")
    assert len(found) == 10
    assert {r["doc_id"] for r in found if r["base_failed"]} >= {1, 2, 3, 5, 6}
    assert next(r for r in found if r["doc_id"] == 1)["n_words"] == 0


def test_passed_keeps_rows_as_they_are(documents):
    rng = random.Random(7)
    rows = [(i, prose(rng, 60), "en", None) for i in range(20)] + [(50, None, "en", "a"), (51, "short", None, "a")]
    frame = documents(rows).selectExpr("*", "text as n_words", "lang as kept")
    found = quality.passed(frame)
    assert found.columns == frame.columns
    assert {r["doc_id"] for r in collected(found)} == set(range(20))


def test_empty_table(documents):
    assert collected(quality.assessed(documents([]))) == []
    assert collected(quality.passed(documents([]))) == []
