import random
import zlib

import numpy as np
from tests.conftest import rows as collected

from stallbook.llm import gru, langid

from .conftest import awkward

SYLLABLES = {"xx": ["ka", "to", "mi", "ru"], "yy": ["sch", "ein", "ung", "ßer"], "zz": ["ción", "os", "ñar", "el"]}


def corpus(n=360):
    rng = random.Random(2)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        words = ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(30)]
        rows.append((i, " ".join(words), lang, "a"))
    return rows


def test_gradients_match_differences():
    net = gru.ByteGru.fresh(3, 2, 1)
    for name in gru._NAMES:
        setattr(net, name, getattr(net, name).astype(np.float64))
    data, live = gru.padded([b"abc", b"hello", b"q"])
    label = np.array([0, 1, 1])
    _, grads = net.gradients(data, live, label)
    rng = np.random.default_rng(0)
    for part, grad in zip(net.parts(), grads, strict=True):
        places = np.argwhere(grad != 0)
        for place in map(tuple, places[rng.permutation(len(places))[:6]]):
            before = part[place]
            part[place] = before + 1e-3
            up = net.gradients(data, live, label)[0]
            part[place] = before - 1e-3
            down = net.gradients(data, live, label)[0]
            part[place] = before
            assert abs((up - down) / 2e-3 - grad[place]) < 1e-3


def test_padding_changes_nothing():
    net = gru.ByteGru.fresh(4, 3, 2)
    alone = net.scores(*gru.padded([b"abc"]))[0][:3, 0]
    beside = net.scores(*gru.padded([b"abc", b"abcdefgh"]))[0][:3, 0]
    assert np.allclose(alone, beside, atol=1e-6)


def test_distributions_are_those_of_the_scores():
    net = gru.ByteGru.fresh(4, 3, 2)
    net.bias = np.array([0.5, 0, -1], np.float32)
    data, live = gru.padded([b"abc", b"", b"hello there", "żół".encode()])
    score = net.scores(data, live)[0]
    expected = np.exp(score) / np.exp(score).sum(axis=2, keepdims=True)
    found = net.distributions(data, live)
    assert found.shape == (3, *data.shape) and np.allclose(np.moveaxis(found, 0, 2), expected, atol=1e-6)


def test_windows_hold_each_byte_once_and_cut_no_character():
    texts = [b"", b"ab cde " * 200, ("żółw" * 300).encode(), b"x" * 1000, b" \t\n" * 90, "日本 語".encode() * 100, b"a"]
    data, (low, high), text = langid.windows(texts)
    for i, t in enumerate(texts):
        mine = np.flatnonzero(text == i)
        own = [bytes(data[a:b]) for a, b in zip(low[mine], high[mine], strict=True)]
        assert b"".join(own) == t.translate(langid._AS_SPACE)
        for piece in own:
            piece.decode()
            assert len(piece) <= langid.WINDOW + langid.BACK
        if i == 1:
            assert all(piece.endswith(b" ") for piece in own)


def test_windows_pool_like_bytes_read_one_window_after_another():
    net = gru.ByteGru.fresh(4, 3, 2)
    scores = langid.TextScores(net, 3)
    texts = [b"ab cde\tab", b"", b"x" * 400 + b" cde", b"ab", b" \n ", "żó łw ".encode() * 70]
    for got, text in zip(scores.pooled(texts), texts, strict=True):
        total, count = np.zeros(3), 0
        framed = b" " + text.translate(langid._AS_SPACE) + b" "
        for low, high in langid.windows([text])[1].T:
            begin, end = max(low - langid.AROUND, 0), min(high + langid.AROUND, len(framed))
            s = net.scores(*gru.padded([framed[begin:end]]))[0][:, 0]
            p = np.exp(s) / np.exp(s).sum(axis=1, keepdims=True)
            for place in range(low, high):
                if framed[place] != 32:
                    total, count = total + p[place - begin], count + 1
        assert np.allclose(got, total / max(count, 1), atol=1e-5)


def test_state_runs_on_over_blanks():
    net = gru.ByteGru.fresh(4, 3, 2)
    scores = langid.TextScores(net, 3)
    same = [np.concatenate([s[own] for _, _, s, own in scores.parts([text])])[-2:] for text in (b"abc de", b"xyz de")]
    assert not np.allclose(*same, atol=1e-6)


def test_positions_of_mixed_texts(documents):
    rows = corpus()
    langs, net = langid.fitted(documents(rows))
    scores = langid.TextScores(net, len(langs))
    held = {name: next(t for i, t, lang, _ in rows if lang == name and zlib.crc32(str(i).encode()) % 3 == 1) for name in SYLLABLES}
    text = "\n".join(held[name] for name in langs)
    found, low = scores.positions(text.encode()), 0
    for n, name in enumerate(langs):
        size = len(held[name].encode())
        part = found[low : low + size]
        assert np.mean(part[part >= 0] == n) > 0.9
        low += size + 1


def test_learns_from_the_rest_and_labels_what_is_held_out(documents):
    rows = corpus()
    found = {r["doc_id"]: r for r in collected(langid.labelled(documents(rows)))}
    for i, _, lang, _ in rows:
        assert found[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= found[i]["score"] <= 1
    assert np.mean([found[i]["lang_pred"] == lang for i, _, lang, _ in rows if found[i]["held_out"]]) > 0.95


def test_awkward_rows(documents):
    rows = corpus(90) + [(1000 + (i or 0), text, None, None) for i, text, *_ in awkward()] + [(2000, "12 34 !", "xx", "a")]
    found = {r["doc_id"]: r for r in collected(langid.labelled(documents(rows)))}
    for i in (1001, 1002, 1003, 2000):
        assert (found[i]["lang_pred"], found[i]["score"]) == ("und", 0.0)
    assert found[1005]["lang_pred"] in SYLLABLES


def test_nothing_to_learn_from(documents):
    assert collected(langid.labelled(documents([]))) == []
    assert {r["lang_pred"] for r in collected(langid.labelled(documents([(1, "abc", None, "a")])))} == {"und"}
