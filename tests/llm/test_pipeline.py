import random
import re
from collections import Counter

import corpus_pipeline
import pytest
from tests.conftest import rows as collected

from stallbook.llm.textstats import WINDOW

from .conftest import awkward
from .test_minmax import brute


def prose(rng, n):
    return " ".join(rng.choice("the a of river stone cloud winter under bright quickly seven garden".split()) + rng.choice(["", "x", "y", "z"]) for _ in range(n))


@pytest.fixture(scope="module")
def raw():
    rng = random.Random(11)
    rows = [(i, f"Share this page\n{prose(rng, 60)}\n{prose(rng, 30)}", "en", "a" if i % 3 else "b") for i in range(120)]
    rows += [(500 + i, rows[i][1] + " extra", "en", "a") for i in range(0, 30, 5)]
    rows += [(600, "too short", "en", "a"), (601, "again and again and again " * 20, "en", "b")]
    return rows + [(700 + (i or 0), t, lang, s) for i, t, lang, s in awkward(20_000)]


def test_each_stage_does_its_work(spark, documents, raw, tmp_path):
    stages = dict(corpus_pipeline.STAGES)
    docs = documents(raw)
    good = stages["quality rules"](spark, docs, "")
    kept = {r["doc_id"] for r in collected(good)}
    assert set(range(120)) <= kept and not kept & {600, 601, 701, 702, 703} and good.columns == docs.columns
    assert all(len(re.findall(r"\S+", r["text"])) >= 2 * WINDOW for r in collected(good))

    lean = stages["line dedup"](spark, good, "")
    texts = {r["doc_id"]: r for r in collected(lean)}
    assert set(texts) == kept and lean.columns == docs.columns
    assert not any("Share this page" in texts[i]["text"] for i in range(120))
    assert all(r["n_chars"] == len(r["text"]) for r in texts.values())

    single = stages["near dedup"](spark, lean, "")
    left = {r["doc_id"] for r in collected(single)}
    expected = brute([(i, r["text"]) for i, r in texts.items() if i is not None], 5)
    assert left - {None} == {i for i, (_, lowest) in expected.items() if i == lowest} and single.columns == docs.columns
    assert not left & {500 + i for i in range(0, 30, 5)}

    mix = stages["source mix"](spark, single, "")
    taken = [r["doc_id"] for r in collected(mix)]
    assert set(taken) <= left and max(taken.count(i) for i in left) <= 2 and mix.columns == docs.columns
    assert len(taken) > len(left)

    pieces = collected(stages["packing"](spark, mix, ""))
    assert {p["doc_id"] for p in pieces} == set(taken)
    ends = {}
    for p in pieces:
        ends[p["sequence_id"]] = ends.get(p["sequence_id"], 0) + p["length"]
    assert all(n == 4096 or n & (n - 1) == 0 for n in ends.values())


def test_repeated_rows_become_one(spark, documents):
    text = "a text of some words that is there twice under one number and key"
    docs = documents([(1, text), (1, text), (2, text), (3, "another text altogether with words of its own in it")])
    found = corpus_pipeline.near_dedup(spark, docs, "")
    assert sorted(r["doc_id"] for r in collected(found)) == [1, 3]


@pytest.mark.parametrize("part_rows", [4096, 50])
def test_rows_that_agree_take_together_what_the_mix_decided(spark, documents, monkeypatch, part_rows):
    monkeypatch.setattr(corpus_pipeline, "_PART_ROWS", part_rows)
    rows = [(None, f"one size of text {i}", "en", "b") for i in range(400)] + [(7, f"text {i} of one number", "en", None) for i in range(9)]
    rows += [(1000 + i, f"another text {i} " * 3, "en", "a") for i in range(300)] + [(None, "the very same", "en", "b")] * 30
    docs = documents(rows)
    decided = collected(corpus_pipeline.mixing.mixed(docs))
    taken = collected(corpus_pipeline.source_mix(spark, docs, ""))

    def total(rows, copies):
        return sum(copies(r) for r in rows if r["doc_id"] is None and r["source"] == "b")

    wanted = total(decided, lambda r: r["copies"])
    assert wanted % 430 and total(taken, lambda r: 1) == wanted
    assert len(taken) == sum(r["copies"] for r in decided)
    times = Counter(r["text"] for r in taken if r["source"] == "b")
    assert max(n for t, n in times.items() if t != "the very same") - min(times[t] for d, t, _, s in rows if d is None and t != "the very same") <= 1
    assert sorted(r["text"] for r in taken) == sorted(r["text"] for r in collected(corpus_pipeline.source_mix(spark, documents(rows[::-1], 5), "")))


def test_run_reads_the_folder_and_takes_an_empty_table(spark, documents, raw, tmp_path):
    documents([]).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert collected(corpus_pipeline.run(spark, str(tmp_path / "none"))) == []
    documents(raw).write.parquet(str(tmp_path / "some" / "documents.parquet"))
    assert len(collected(corpus_pipeline.run(spark, str(tmp_path / "some")))) > 100
