import random

import numpy as np
from pyspark.sql import functions as F

from fundlens.llm import langid

TEXT = {
    "en": "the water utility has approved the second bidding round because the rainy season began early and the borrower will review the tariff study".split(),
    "fr": "le service des eaux a approuvé la deuxième étude tarifaire parce que la saison des pluies a commencé tôt et l'emprunteur va examiner les états".split(),
    "es": "la empresa de agua ha aprobado la segunda licitación porque la temporada de lluvias comenzó antes y el prestatario va a revisar el estudio".split(),
    "ru": "водоканал утвердил второй тендер из-за раннего начала дождей и заёмщик скоро обновит план закупок после проверки счёта".split(),
}
LANGS = [("en", "eng", "English"), ("fr", "fra", "Français"), ("es", "spa", "Español"), ("ru", "rus", "Русский")]


def _text(rng, lang, n=12):
    return " ".join(rng.choice(TEXT[lang]) for _ in range(n)).capitalize() + "."


def test_languages_and_segments(spark):
    rng = random.Random(8)
    docs = []
    for k in range(240):
        lang = list(TEXT)[k % 4]
        docs.append((k, "\n".join(_text(rng, lang) for _ in range(3)), lang if k % 10 else "xx"))
    docs.append((900, _text(rng, "fr", 30) + "\r\n \n" + _text(rng, "ru", 8) + "\n12 / 2020\n" + _text(rng, "fr", 20), "fr"))
    docs += [(901, None, "en"), (902, "", "en"), (903, " \n ", None), (904, "123 456", "en"), (905, _text(rng, "es", 40_000), None), (906, _text(rng, "en").upper(), None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumn("confidence", F.lit("clash"))
    labelled = df.withColumn("label", langid.label_language(F.col("lang"), LANGS))
    profiles = langid.train(labelled, "text", "label", "doc_id")
    got = {(r["doc_id"], r["para_no"]): r for r in langid.segments(df, profiles).collect()}
    right = sum(got[k, 0]["lang"] == list(TEXT)[k % 4] for k in range(240))
    assert right == 240
    assert [got[900, k]["lang"] for k in range(5)] == ["fr", "fr", "ru", "fr", "fr"] and got[900, 0]["confidence"] < 1
    assert not any(k[0] in (901, 902, 903) for k in got) and got[904, 0]["lang"] is None
    assert got[905, 0]["lang"] == "es" and got[906, 0]["lang"] == "en"
    assert all(0 <= r["confidence"] <= 1 for r in got.values())


def test_labels(spark):
    df = spark.createDataFrame([(x,) for x in ["EN", "eng", "English", "en-XX", "en_latn", " fr ", "français", "xx", "", None, "n/a", "ru_cyrl"]], "l string")
    got = [r[0] for r in df.select(langid.label_language(F.col("l"), LANGS)).collect()]
    assert got == ["en"] * 5 + ["fr", "fr", None, None, None, None, "ru"]


def test_untrained(spark):
    df = spark.createDataFrame([(1, "text here", None)], "doc_id long, text string, lang string")
    assert langid.train(df, "text", "lang", "doc_id") is None
    assert [r["lang"] for r in langid.segments(df, None).collect()] == [None, None]


def test_scripts_and_scans():
    assert langid.fold("План ЗАКУПОК").strip() == "plan zakupok" and langid.fold("cance1ó 1ot").strip() == "cancelo lot"


def test_table_of_products_is_the_bundle():
    """The looked-up cosine against texts that are bundled vector by vector: same order, little apart."""
    rng = random.Random(4)
    space = langid.Space()
    width = len(langid.ALPHABET) ** langid.NGRAM
    bundled = np.zeros((len(TEXT), width))
    for k, lang in enumerate(TEXT):
        _, code, count = langid.ngram_counts([_text(rng, lang, 400)])
        bundled[k, code] = count
    profiles = langid.Profiles(list(TEXT), bundled, (bundled > 0) * 1.0, space)
    protos = np.stack([sum(bundled[k, c] * profiles.weight[c] * space.vectors(np.array([c]))[0] for c in np.flatnonzero(bundled[k])) for k in range(len(TEXT))])
    protos /= np.linalg.norm(protos, axis=1, keepdims=True)
    texts = [_text(rng, rng.choice(list(TEXT)), rng.choice([3, 8, 30])) for _ in range(60)]
    text, code, count = langid.ngram_counts(texts)
    got = profiles.cosines(len(texts), text, code, count)
    for k in range(len(texts)):
        mine = text == k
        vector = (space.vectors(code[mine]) * (count[mine] * profiles.weight[code[mine]])[:, None]).sum(axis=0)
        want = protos @ vector / np.linalg.norm(vector)
        assert np.abs(got[k] - want).max() < 0.06 and got[k].argmax() == want.argmax()


def test_counts_of_a_batch():
    text, code, count = langid.ngram_counts(["abab", "", "12 / 3", " \x02 ", "a  b", "é"])
    got = {}
    for t, c, n in zip(text.tolist(), code.tolist(), count.tolist()):
        letters = "".join(langid.ALPHABET[c // len(langid.ALPHABET) ** k % len(langid.ALPHABET)] for k in (2, 1, 0))
        got.setdefault(t, {})[letters] = n
    assert got == {0: {" ab": 1, "aba": 1, "bab": 1, "ab ": 1}, 4: {" a ": 1, "a b": 1, " b ": 1}, 5: {" e ": 1}}
    assert all(len(x) == 0 for x in langid.ngram_counts([]))


def test_names_are_left_out():
    names = langid.Names(["Torvia", "North Torvia", "", None])
    assert names.blank("in north torvia, torvian torvia") == "in  , torvian  " and langid.Names([]).blank("x") == "x"
