"""Sentence ends learnt from counts."""

import random

import pytest

from loomframe.operators import sentences


def corpus():
    rng = random.Random(1)
    names, verbs = ["Smith", "Jones", "Miller", "Brown"], ["paid", "saw", "met", "called"]
    out = []
    for i in range(400):
        out.append(f"Dr. {rng.choice(names)} {rng.choice(verbs)} {rng.randrange(9)}.{rng.randrange(99):02} . "
                   f"The man {rng.choice(verbs)} us e.g. in the town. The end was {rng.choice(['near', 'far', 'here'])}. "
                   f"We {rng.choice(verbs)} {rng.choice(names)} in the town at noon. The day went on near here or far from the noon and the town")
    return out


@pytest.fixture(scope="module")
def learnt(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(corpus())] + [(1_000, None), (1_001, "  ")], "id long, text string")
    return sentences.learn(df.repartition(3), "text")


def cut(spark, learnt, text):
    df = spark.createDataFrame([(1, text)], "id long, text string")
    return [" ".join(s) for s in df.select(sentences.sentences(df["text"], *learnt.words()).alias("s")).first()["s"] or []]


def test_abbreviations_and_starters(learnt):
    abbreviations, starters = learnt.words()
    assert {"dr", "e.g"} <= set(abbreviations) and not {"town", "near", "noon"} & set(abbreviations)
    assert "the" in starters and not {"smith", "paid"} & set(starters)


@pytest.mark.parametrize("text, parts", [
    ("Dr. Smith paid 3.14.", ["Dr. Smith paid 3.14."]),
    ("We met Dr. Jones. He left", ["We met Dr. Jones.", "He left"]),
    ("He saw J. Smith. Then?! Yes! (No.) And so", ["He saw J. Smith.", "Then?!", "Yes!", "(No.)", "And so"]),
    ("Well... maybe. Well... Maybe", ["Well... maybe.", "Well...", "Maybe"]),
    ("It is here e.g. The man", ["It is here e.g.", "The man"]),
    ("It is here e.g. the man", ["It is here e.g. the man"]),
    ("see www.x.org for 1.5 or 2,5 today", ["see www.x.org for 1.5 or 2,5 today"]),
    ("", []), ("  \n ", []), (".", ["."]), (None, [])])
def test_cuts(spark, learnt, text, parts):
    assert cut(spark, learnt, text) == parts


def test_words_of_sentences(spark, learnt):
    df = spark.createDataFrame([(1, "Dr. Brown's 2 cats. -- ! Fine"), (2, None)], "id long, text string")
    got = [tuple(r) for r in sentences.split_sentences(df, "text", ["id"], learnt).collect()]
    assert got == [(1, 0, ["Dr", "Brown's", "2", "cats"]), (1, 1, ["Fine"])]


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([(1, None)], "id long, text string")
    assert sentences.learn(none, "text").words() == ([], [])
    only_stops = spark.createDataFrame([(1, "a. b. c.")], "id long, text string")
    assert sentences.learn(only_stops, "text").words() == ([], [])
    assert sentences.split_sentences(none, "text", ["id"]).collect() == []


def test_a_long_text_is_cut_in_linear_time(spark, learnt):
    text = "The man met Dr. Smith in the town. " * 20_000
    assert len(cut(spark, learnt, text)) == 20_000
