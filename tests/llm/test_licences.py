import random
import re

from seriesloom.llm import licences

from .support import ODD_TEXTS, documents


def best(line, templates, percent):
    own = set(licences.bigrams_of(line))
    found = []
    for name, text in templates.items():
        grams = set(licences.bigrams_of(text))
        shared = len(own & grams)
        if own and grams and 200 * shared >= percent * (len(own) + len(grams)):
            found.append((-shared / (len(own) + len(grams)), name, shared, len(own), len(grams)))
    return min(found)[1:] if found else None


def expected(texts, templates, percent=80, whole=False):
    out = {}
    for doc, text in enumerate(texts):
        if text is not None:
            for line, unit in enumerate([text] if whole else text.split("\n")):
                if hit := best(unit, templates, percent):
                    out[doc, line] = hit
    return out


def got(frame):
    return {(r.doc, r.line): (r.licence, r.shared, r["size"], r.template_size) for r in frame.collect()}


def test_against_brute_force(spark):
    rng = random.Random(4)
    notices = list(licences.NOTICES.values())
    texts = list(ODD_TEXTS)
    for _ in range(300):
        w = re.split(" ", rng.choice(notices))
        for _ in range(rng.randrange(3)):
            w.insert(rng.randrange(len(w) + 1), rng.choice(["the", "new", "License"]))
        line = " ".join(w) if rng.random() < 0.5 else "  ".join(w).upper() + " ©"
        texts.append("\n".join(rng.sample(["some words here", line, "", "x", "the the the the"], 4)))
    docs = documents(spark, texts).withColumnRenamed("lang", "size").repartition(3)
    for percent in (50, 80, 100):
        assert got(licences.scanned(docs, percent=percent)) == expected(texts, licences.NOTICES, percent)
    whole = {"a": "one two three\nfour five", "b": "nothing", "c": "", "d": "one two three four five"}
    texts = ["ONE two\nthree four five!", "one two three four", "nothing", None, "one two three four five " * 50]
    assert got(licences.scanned(documents(spark, texts), whole, whole=True)) == expected(texts, whole, whole=True)


def test_size_bounds_lose_nothing():
    for percent in (1, 50, 80, 99, 100):
        for a in range(1, 60):
            reach = [b for b in range(1, 13_000) if 200 * min(a, b) >= percent * (a + b)]
            assert reach == list(licences.sizes_for(a, percent)), (percent, a)


def test_repeated_rows_and_empty_tables(spark):
    docs = documents(spark, [licences.NOTICES["MIT"]])
    assert licences.scanned(docs.union(docs)).count() == 2
    unnamed = spark.createDataFrame([(None, licences.NOTICES[n]) for n in ("MIT", "ISC")], "doc_id long, text string")
    assert {r.licence for r in licences.scanned(unnamed).collect()} == {"MIT", "ISC"}
    assert licences.scanned(docs.limit(0)).count() == 0
    assert licences.scanned(docs, {}).count() == 0
