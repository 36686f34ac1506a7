"""Rank-order profiles against a plain implementation, and held-out accuracy."""

from collections import Counter

from tidemark.llm import language, queries

from .samples import awkward, empty, values


def plain_grams(text):
    letters = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
    padded = " " + " ".join(letters.split()) + " "
    if not padded.strip():
        return Counter()
    found = Counter()
    for n in (1, 2, 3):
        for i in range(len(padded) - n + 1):
            gram = padded[i : i + n]
            if gram.strip() and not (n == 3 and gram[1] == " ") and gram != " ":
                found[gram] += 1
    return found


def number(gram):
    total = 0
    for c in gram:
        total = total << 21 | ord(c)
    return total


def test_grams_match_plain_count():
    for text in ("Hello, wörld! a  b", "", " 12 ", "İstanbul x", "a", "tschüß " * 50):
        found, n = language.grams(text)
        assert dict(zip(found.tolist(), n.tolist())) == {
            number(g): k for g, k in plain_grams(text).items()
        }


def test_profiles_match_plain_ranks(spark):
    rows = [("en", "the cat and the hat"), ("en", None), (None, "x"), ("de", "der Hut und"), ("de", "12")]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = {(r.lang, r.gram): r.rank for r in language.learn_profiles(docs, size=20).collect()}
    for lang in ("en", "de"):
        total = Counter()
        for own, text in rows:
            if own == lang and text:
                total += plain_grams(text)
        ordered = sorted((-n, number(g)) for g, n in total.items())[:20]
        assert {g: got[lang, g] for _, g in ordered} == {g: k for k, (_, g) in enumerate(ordered)}


def test_awkward_texts(spark):
    taught = spark.createDataFrame(
        [("en", "the word and the other word are here"), ("fr", "le mot et la parole sont là")],
        "lang string, text string",
    )
    profiles = language.learn_profiles(taught)
    docs = awkward(spark, ["lang_pred", "score", "lang"])
    rows = language.identify(docs, profiles).collect()
    assert len(rows) == docs.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id not in (2, None)}
    for doc in (3, 4, 5, 7):
        assert (by_id[doc].lang_pred, by_id[doc].score) == ("und", 0.0)
    assert by_id[8].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in rows)
    again = language.identify(docs.repartition(2), profiles)
    assert values(again, *again.columns) == sorted((tuple(r) for r in rows), key=repr)


def test_nothing_learned_and_nothing_to_judge(spark):
    profiles = language.learn_profiles(empty(spark, "lang string, text string"))
    docs = awkward(spark, [])
    assert {r.lang_pred for r in language.identify(docs, profiles).collect()} == {"und"}
    assert language.identify(empty(spark), profiles).collect() == []


def test_held_out_accuracy(spark, testdata):
    judged = queries.op7_language(spark, testdata)
    docs = spark.read.parquet(f"{testdata}/documents.parquet").select("doc_id", "lang")
    rows = judged.where("held_out").join(docs, "doc_id").where("lang IS NOT NULL").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows) > 0
