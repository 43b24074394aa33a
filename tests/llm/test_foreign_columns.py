"""Extra columns, whatever their names, change no operator's result and no stage's rows."""

import random

import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from stallbook.llm import licenses, minmax, mixing, packing, pii, quality, secrets, spelling

# names the operators and stages use for themselves
NAMES = (
    "rows copies parts more size taken source_size target stays kept n_words id _id _size line host page lines bucket members "
    "set_key bands component v rule bucket_of low high base_failed block unit group kind spans tokens start length offset "
    "prompt word n m hash key value found"
).split()


def texts():
    rng = random.Random(21)
    words = "stone river cloud winter garden letter orange window silver market".split()
    rows = [(i, "\n".join(" ".join(rng.choices(words, k=12)) + f" {i}" for _ in range(6)), "en", "ab"[i % 2]) for i in range(60)]
    rows += [(100, rows[0][1] + " more", "en", "a"), (101, "mail me at someone@example.com password=abcdefgh12345", "en", "b")]
    rows += [(None, None, None, None), (103, "", "en", None)]
    return rows


def clashing(frame):
    return frame.withColumns({name: F.lit(f"{name} of another") for name in NAMES})


def plain(frame, columns=None):
    return sorted(map(str, frame.select(*(columns or frame.columns)).collect()))


OPERATORS = {
    "packing": lambda d: packing.packed(d, public_tokenizers.path("word_bpe_49k.json")),
    "licenses": licenses.scanned,
    "minmax": lambda d: minmax.near_duplicates(d, 2),
    "quality": quality.assessed,
    "pii": pii.found_in,
    "secrets": lambda d: secrets.digested(secrets.scanned(d)),
    "spelling": lambda d: spelling.variants(spelling.counted(d)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operators(documents, name):
    docs = documents(texts(), partitions=1)
    assert plain(OPERATORS[name](clashing(docs))) == plain(OPERATORS[name](docs))


def test_mixing(documents):
    docs = documents(texts(), partitions=1)
    columns = ["doc_id", "source", "size", "copies"]
    assert plain(mixing.mixed(clashing(docs)), columns) == plain(mixing.mixed(docs), columns)


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages(spark, documents, name):
    docs = documents(texts(), partitions=1)
    stage = dict(corpus_pipeline.STAGES)[name]
    found, expected = stage(spark, clashing(docs), ""), stage(spark, docs, "")
    assert plain(found, expected.columns) == plain(expected)
    if name != corpus_pipeline.STAGES[-1][0]:
        assert found.columns == [*docs.columns, *NAMES]
        assert {tuple(r) for r in found.select(*NAMES).collect()} == {tuple(f"{n} of another" for n in NAMES)}
