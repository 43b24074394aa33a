import random

from tests.conftest import rows as collected

from stallbook.llm import boilerplate

from .conftest import awkward


def test_drops_lines_by_their_share_of_the_site(documents):
    rows = [(i, f"menu\nline {i}\n  menu \n\nrare", "en", "a") for i in range(20)]
    rows += [(100 + i, "menu\nother" if i < 2 else f"text {i}", "en", "b") for i in range(20)]
    rows += [(200, "menu\nmine", "en", None)]
    found = {r["doc_id"]: r for r in collected(boilerplate.without_boilerplate(documents(rows), "source", "text", dropped="n"))}
    assert found[3]["text"] == "line 3\n" and found[3]["n"] == 3
    assert found[100]["text"] == "menu\nother" and found[100]["n"] == 0
    assert found[200]["text"] == "menu\nmine"


def test_the_ratio_must_be_exceeded(documents):
    rows = [(i, ("five" if i < 5 else "") + f"\nx{i}" + ("\nsix" if i < 6 else ""), "en", "a") for i in range(50)]
    found = collected(boilerplate.without_boilerplate(documents(rows), "source", "text"), "doc_id")
    assert "five" in found[0]["text"] and "six" not in found[0]["text"]


def test_copies_of_a_page_count_once(documents):
    rows = [(i, "one page\nmany times", "en", "a") for i in range(30)] + [(100 + i, f"p{i}", "en", "a") for i in range(3)]
    found = collected(boilerplate.without_boilerplate(documents(rows), "source", "text"))
    assert sum(r["text"] == "one page\nmany times" for r in found) == 30


def test_small_hosts_have_the_same_ratio(documents):
    rows = [(i, f"header\nown {i}", "en", "four pages") for i in range(4)]
    rows += [(100 + i, ("footer\n" if i < 4 else "") + f"own {i}" + ("\nthree" if i < 3 else ""), "en", "thirty") for i in range(30)]
    rows += [(200, "header\nalone", "en", "one page"), (201, "header\nalone", "en", "one page")]
    found = {r["doc_id"]: r for r in collected(boilerplate.without_boilerplate(documents(rows), "source", "text", dropped="n"))}
    assert [found[i]["text"] for i in range(4)] == [f"own {i}" for i in range(4)]
    assert found[100]["text"] == "own 0\nthree" and found[103]["text"] == "own 3" and found[104]["n"] == 0
    assert found[200]["text"] == "header\nalone" and found[201]["n"] == 0


def test_awkward_rows_and_clashing_columns(documents):
    frame = documents(awkward())
    for name in ("host", "line", "lines", "page", "pages", "with_line"):
        frame = frame.withColumn(name, frame["lang"])
    found = collected(boilerplate.without_boilerplate(frame, "source", "text"), "doc_id")
    assert sorted((str(r["doc_id"]), r["text"]) for r in found) == sorted((str(r[0]), r[1]) for r in awkward())
    assert set(found[0]) == set(frame.columns)


def test_empty_table(documents):
    assert collected(boilerplate.without_boilerplate(documents([]), "source", "text", dropped="n")) == []


def test_hosts_and_lines_of_pages(spark):
    frame = spark.createDataFrame(
        [
            ("https://u:p@Www.A.example:80/x?y", "<p>a<br>b</p><script>var t='</p>';</script><!-- c\n --><style>d</style> e"),
            ("nothing", None),
            (None, ""),
        ],
        "url string, html string",
    )
    found = [tuple(r) for r in frame.select(boilerplate.host_of(frame["url"]), boilerplate.lines_of_html(frame["html"])).collect()]
    assert found == [("www.a.example", "\na\nb\ne"), (None, None), (None, "")]


def test_lines_of_large_sources_are_found_at_a_small_share(documents):
    n, rng = 2000, random.Random(5)
    words = [f"{a}{b}" for a in "river stone cloud winter garden quickly seven bright".split() for b in "abcdefgh"]

    def line(k):
        return " ".join(rng.choice(words) for _ in range(k))

    planted = {"Read more articles on this and other topics on our pages": 100, "Copyright by the authors of this site, all rights": 50,
               "Please sign in to leave a comment below this article": 25, "Back to top of page": 100, "Menu": 300}
    passage = ["A passage of several lines that a site puts", "under each of its articles, whatever they", "are about, from the first to the last one"]
    texts = [[line(8) for _ in range(rng.randint(2, 12))] for _ in range(n)]
    for text, often in planted.items():
        for i in rng.sample(range(n), often):
            texts[i].insert(rng.randint(0, len(texts[i])), text)
    for i in rng.sample(range(n), 40):
        texts[i] += passage
    # clean: short words and lines under their ratio, and near-copies, each with a line of its own
    clean = {"Yes.": 60, "Good morning": 30, "This line is quoted by a few of the texts only": 8}
    for text, often in clean.items():
        for i in rng.sample(range(n), often):
            texts[i].append(text)
    copied = [line(8) for _ in range(20)]
    copies = [[line(8) if k == j % 20 else x for k, x in enumerate(copied)] for j in range(60)]
    rows = [(i, "\n".join(lines), "en", "large") for i, lines in enumerate(texts + copies)]
    found = collected(boilerplate.without_boilerplate(documents(rows), "source", "text", dropped="n", sources=True), "doc_id")
    gone = set(planted) | set(passage)
    for r in found:
        before = (texts + copies)[r["doc_id"]]
        assert r["text"].split("\n") == [x for x in before if x not in gone], r["doc_id"]
        assert r["n"] == sum(x in gone for x in before)


def test_small_and_awkward_sources(documents):
    frame = documents([(i, f"Share this page\nown text {i}", "en", "small") for i in range(6)] + awkward())
    found = {(r["doc_id"], r["source"]): r["text"] for r in collected(boilerplate.without_boilerplate(frame, "source", "text", sources=True))}
    assert [found[i, "small"] for i in range(6)] == [f"own text {i}" for i in range(6)]
    assert {k: v for k, v in found.items() if k[1] != "small"} == {(r[0], r[3]): r[1] for r in awkward()}
    assert collected(boilerplate.without_boilerplate(documents([]), "source", "text", sources=True)) == []


def test_sources_of_few_texts_lose_shared_lines_but_no_copies(documents):
    own = [[f"line {i} {k} of its own" for k in range(4)] for i in range(40)]
    rows = [(i, "\n".join(["header", *own[i]]), "en", "two") for i in range(2)]
    rows += [(10 + i, "\n".join(["header", *own[i], "footer"]), "en", "four") for i in range(4)]
    # copies of a text with one line changed; the line that a third text shares with them is boilerplate
    copies = [[*own[5][:3], f"changed {i}", "subscribe"] for i in range(2)]
    rows += [(20 + i, "\n".join(x), "en", "copies") for i, x in enumerate([*copies, [*own[6], "subscribe"]])]
    rows += [(30 + i, "\n".join([*own[7], f"changed {i}"]), "en", "only copies") for i in range(3)]
    # a line of four texts is above the ratio among 39 texts, not among 40
    rows += [(100 + i, "\n".join([*own[i], *["note"] * (i < 4)]), "en", "39") for i in range(39)]
    rows += [(200 + i, "\n".join([*own[i], *["note"] * (i < 4)]), "en", "40") for i in range(40)]
    rows += [(300, "one\ntext", "en", "one"), (301, "one\ntext", "en", "one")]
    found = collected(boilerplate.without_boilerplate(documents(rows), "source", "text", sources=True), "doc_id")
    gone = {"two": {"header"}, "four": {"header", "footer"}, "copies": {"subscribe"}, "39": {"note"}}
    before = {r[0]: r[1].split("\n") for r in rows}
    assert len(found) == len(rows)
    for r in found:
        assert r["text"].split("\n") == [x for x in before[r["doc_id"]] if x not in gone.get(r["source"], ())], r["doc_id"]
