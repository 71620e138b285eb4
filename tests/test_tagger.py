import itertools
import random

import numpy as np
import pytest

from shopweave.operators import tagger, themes
from shopweave.plans import adapters

TREEBANK = [
    (["Die", "Schuhe", "sind", "schön"], ["DET", "NOUN", "AUX", "ADJ"], ["der", "Schuh", "sein", "schön"]),
    (["Der", "Schuh", "ist", "teuer"], ["DET", "NOUN", "AUX", "ADJ"], ["der", "Schuh", "sein", "teuer"]),
    (["Die", "Lieferungen", "sind", "teuer"], ["DET", "NOUN", "AUX", "ADJ"], ["der", "Lieferung", "sein", "teuer"]),
    (["Die", "Zahlung", "ist", "schön"], ["DET", "NOUN", "AUX", "ADJ"], ["der", "Zahlung", "sein", "schön"]),
    (["Teuer", "ist", "der", "Schuh"], ["ADJ", "AUX", "DET", "NOUN"], ["teuer", "sein", "der", "Schuh"]),
]


def treebank(spark, rows=TREEBANK):
    return spark.createDataFrame(rows, "words array<string>, tags array<string>, lemmas array<string>")


def texts(spark, *rows):
    return spark.createDataFrame(list(rows), "doc_id string, text string")


def test_best_path_equals_all_paths():
    rng = random.Random(7)
    for _ in range(60):
        tags = ["A", "B", "C"][: rng.randint(1, 3)]
        heads = {f"_={w}": np.array([rng.randint(-3, 0) for _ in tags]) for w in "xyz"}
        moves = np.array([[rng.randint(-3, 0) for _ in tags] for _ in range(len(tags) + 1)])
        model = tagger.Tagger(tags, moves, heads, {}, 4)
        keys = ["_" + rng.choice("xyz") for _ in range(rng.randint(1, 6))]

        def score(path):
            return sum(moves[0 if i == 0 else path[i - 1] + 1][t] + heads["_=" + keys[i][1:]][t] for i, t in enumerate(path))

        paths = list(itertools.product(range(len(tags)), repeat=len(keys)))
        top = max(map(score, paths))
        # Of equal paths: the smaller last tag, then the smaller tag before it.
        assert model.path(keys) == list(min((p for p in paths if score(p) == top), key=lambda p: p[::-1]))


def test_capitals_at_the_start_say_nothing_and_endings_tag_new_words(spark):
    model = tagger.train_tagger(treebank(spark))
    got = {(r["word"], r["upos"], r["lemma"]) for r in tagger.tag_sentences(texts(spark, ("a", "Teuer ist die Bestellung. Die Bestellungen sind schön!")), model).collect()}
    assert ("Teuer", "ADJ", "teuer") in got
    assert ("Bestellung", "NOUN", "bestellung") in got
    assert ("Bestellungen", "NOUN", "bestellung") in got
    assert ("sind", "AUX", "sein") in got


def test_odd_texts_and_extra_columns(spark):
    model = tagger.train_tagger(treebank(spark))
    long = "der Schuh ist schön " * 5000
    df = texts(spark, ("a", None), ("b", ""), ("c", " .!? 12 "), (None, "Schuh"), ("d", "Schuh"), ("d", "Schuh"), ("e", long))
    got = tagger.tag_sentences(df.selectExpr("*", "1 AS sent", "2 AS words"), model).collect()
    assert sorted({r["doc_id"] or "" for r in got}) == ["", "d", "e"]
    assert sum(r["doc_id"] == "d" for r in got) == 2
    assert [r["pos"] for r in got if r["doc_id"] == "e"] == list(range(20000))
    assert tagger.tag_sentences(df.limit(0), model).count() == 0


def test_bad_training_rows_teach_nothing(spark):
    bad = [(None, None, None), (["x"], ["A", "B"], ["x"]), ([], [], []), (["y"], [None], ["y"]), (["Haus"], ["NOUN"], [None])]
    model = tagger.train_tagger(treebank(spark, TREEBANK + bad))
    assert model.tags == ["ADJ", "AUX", "DET", "NOUN"]
    assert model.lemma("NOUN", "haus") == "haus"
    with pytest.raises(ValueError, match="none"):
        tagger.train_tagger(treebank(spark, bad[:3]))
    with pytest.raises(ValueError, match="more"):
        tagger.train_tagger(treebank(spark, [([f"w{i}"], [f"T{i}"], [f"w{i}"]) for i in range(65)]))


def test_bounds_keep_frequent_words_and_endings_decide_the_rest(spark):
    model = tagger.train_tagger(treebank(spark), words=2, endings=3)
    assert sum(k[1] == "=" for k in model.heads) == 2 and sum(k[1] == "~" for k in model.heads) == 3
    assert tagger.tag_sentences(texts(spark, ("a", "Die Lieferungen sind teuer")), model).count() == 4


def test_model_does_not_depend_on_partitions(spark):
    one, many = (tagger.train_tagger(treebank(spark).repartition(n)) for n in (1, 7))
    assert one.tags == many.tags and one.rules == many.rules and (one.moves == many.moves).all()
    assert one.heads.keys() == many.heads.keys() and all((one.heads[k] == many.heads[k]).all() for k in one.heads)


def test_tagging_does_not_shuffle(spark):
    plan = tagger.tag_sentences(texts(spark, ("a", "Schuh")), tagger.train_tagger(treebank(spark)))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "ArrowEvalPython" in plan


def test_held_out_accuracy(spark, sf_dir):
    """Tags of documents that were not learnt from; always the most frequent tag would be right in far fewer words."""
    tagged = adapters.tagged_sentences(spark, sf_dir)
    model = tagger.train_tagger(tagged.filter("crc32(CAST(doc_id AS STRING)) % 5 <> 0"))
    held = tagged.filter("crc32(CAST(doc_id AS STRING)) % 5 = 0")
    documents = adapters.table(spark, sf_dir, "documents").filter("lang = 'de' AND crc32(CAST(doc_id AS STRING)) % 5 = 0").select("doc_id", "text")
    truth = held.selectExpr("doc_id", "sent", "posexplode(arrays_zip(tags, lemmas)) AS (pos, t)").selectExpr("doc_id", "sent", "pos", "t.tags", "t.lemmas")
    rows = tagger.tag_sentences(documents, model).join(truth, ["doc_id", "sent", "pos"]).collect()
    right = sum(r["upos"] == r["tags"] for r in rows) / len(rows)
    base = max(sum(r["tags"] == t for r in rows) for t in model.tags) / len(rows)
    lemmas = sum(r["lemma"] == r["lemmas"] for r in rows) / len(rows)
    print(f"tags {right:.4f} lemmas {lemmas:.4f} most frequent tag {base:.4f} words {len(rows)}")
    assert right > 0.97 and right > base and lemmas > 0.99


def test_themes_take_the_tagger(spark):
    model = tagger.train_tagger(treebank(spark))
    df = spark.createDataFrame([("1", "de", 1, "", "Teuer ist die Lieferung. Die Lieferungen sind teuer."), ("2", "de", 5, "", "Die Schuhe sind schön.")], "id string, language string, stars int, title string, text string")
    got = {(r["rating_group"], r["word"]): r["n"] for r in themes.noun_themes(df, lambda t: tagger.tag_sentences(t, model), stop_words=()).collect()}
    assert got == {(themes.CRITICAL, "lieferung"): 2, (themes.POSITIVE, "schuh"): 1}


def test_sentences_of_a_batch_take_their_steps_together(spark):
    rng = random.Random(11)
    tags = ["A", "B", "C"]
    heads = {f"_={w}": np.array([rng.randint(-2, 0) for _ in tags]) for w in "wxyz"}
    model = tagger.Tagger(tags, np.array([[rng.randint(-2, 0) for _ in tags] for _ in range(4)]), heads, {}, 4)
    some = [["_" + rng.choice("wxyz") for _ in range(rng.choice([1, 1, 2, 5, 40]))] for _ in range(50)]
    together = model.paths(model.emissions([k for keys in some for k in keys]), np.array([len(keys) for keys in some])).tolist()
    assert together == [t for keys in some for t in model.path(keys)]
    assert model.paths(model.emissions([]), np.array([], np.int64)).tolist() == []


def test_texts_are_tagged_once_for_themes(spark):
    model, seen = tagger.train_tagger(treebank(spark)), spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame([("1", "de", 1, "", "Die Lieferungen sind teuer."), ("2", "de", 5, "", "Die Schuhe sind schön.")], "id string, language string, stars int, title string, text string")
    got = themes.noun_themes(df, lambda t: tagger.tag_sentences(t.mapInArrow(count, t.schema), model)).collect()
    assert len(got) == 1 and seen.value == 2
