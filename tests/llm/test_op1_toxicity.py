import random

from pyspark.sql import functions as F

from editstream.llm.op1_toxicity import (
    KINDS,
    OTHER,
    QUOTE,
    REACH,
    TARGET,
    Grammar,
    curve_score,
    features,
    fit,
    held_out,
    op1_clause_grammar,
    read,
    score,
)

G = Grammar({"scum": 2.0, "idiot": 3.0}, {"lowei": 4.0})


def out(text):
    return {k: v for k, v in zip(KINDS, G.read(text)) if v}


def test_transducers():
    assert out("") == out("a calm text. you said so") == {}
    assert out("an idiot") == {"plain": 3.0}
    assert out("You are an Idiot!") == {"aimed": 3.0}
    assert out("idiot, you.") == {"aimed": 3.0}
    assert out("he is not an idiot") == {"negated": 3.0}
    assert out("someone said: fine. someone wrote idiot") == {"reported": 3.0}
    assert out('the word "idiot" is old') == {"reported": 3.0}
    assert out("they will kill you") == {"threat": 1.0}
    assert out("kill the process") == {}
    assert out("You there. a scum") == {"plain": 2.0}  # the target is in another clause
    assert out("loweiung scums idiotic alowei") == {"plain": 4.0}  # beginnings only where they are entries
    assert out("idiot scum idiot") == {"plain": 8.0}


def test_composed_machine_accepts_confirmed_guesses_only():
    far = " word" * REACH
    assert out("kill you kill") == {"threat": 1.0}
    assert out("kill" + far + " you") == {}                      # the target is out of reach
    assert out("kill" + far.removesuffix(" word") + " you") == {"threat": 1.0}
    assert out("I will not kill you") == {"negated": 1.0}
    assert out("idiot scum loweix you") == {"aimed": 9.0}        # one target confirms all guesses
    assert out("you idiot" + far + " scum") == {"aimed": 3.0, "plain": 2.0}
    assert out('kill " you') == {"threat": 1.0}                  # a quote is no token between
    reached = len(G.machine.made)
    out("you idiot kill not said " * 50)
    assert reached <= len(G.machine.made) < 3000                 # arcs are made once
    start = G.machine.start
    assert G.machine.accepts(start) and [k for _, k in G.machine.arcs(start, OTHER)] == [""]
    assert {len(G.machine.arcs(start, s)) for s in (TARGET, QUOTE)} == {1}


def test_kinds_are_ordered():
    value = lambda text: features(G.read(text))[0]
    calm = value("a calm day")
    assert calm < value("you are not an idiot") < value("he said you are an idiot") < value("an idiot") < value("you are an idiot")
    assert calm < value("I will not kill you") < value("I will kill you")


def test_long_and_repeated_texts_and_clashing_columns(spark):
    long = "word " * 400_000 + "you idiot. " + "x" * 1_000_000
    docs = spark.createDataFrame([(1, long, "kept", 5)] * 2 + [(2, "fine", None, None)], "doc_id long, text string, toxic string, sum long")
    rows = read(docs, {"idiot": 3.0}, {}, ["doc_id", "toxic", "sum"]).collect()
    assert sorted((r.doc_id, r.toxic, r.sum, r.sums[1]) for r in rows if r.doc_id == 1) == [(1, "kept", 5, 3.0)] * 2
    assert [sum(r.sums) for r in rows if r.doc_id == 2] == [0.0]


def test_many_clauses_are_read_once():
    assert out("idiot scum.\n" * 500) == {"plain": 2500.0}


def test_learns_and_leaves_clean_alone(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows = [(i, f"the {word()} {'zork' if i % 4 == 0 else 'blue'} {word()} of {word()} and {'murx' + 'abc'[i % 3] if i % 4 == 0 else 'good'} {word()}")
            for i in range(400)]
    docs = spark.createDataFrame([(*r, "x") for r in rows] + [(1000, None, "x"), (1001, "", "x"), (None, "zork", "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(300)] + [(5, 0, 0), (7, 0, None)], "doc_id long, quality int, toxic int")
    model = fit(docs, labels)
    assert "zork" in model.words and not {"the", "blue", "good"} & set(model.words)
    got = {r.doc_id: r for r in score(docs, model, ["doc_id"]).collect()}
    assert len(got) == 403 and all(0 <= r.score <= 1 for r in got.values())
    assert all(got[i].predicted == int(i % 4 == 0) for i in range(400))
    assert got[1000].predicted == got[1001].predicted == 0 and got[None].predicted == 1


def test_no_labels_and_empty(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.predicted for r in score(docs, fit(docs, none), ["doc_id"]).collect()] == [0]
    assert score(docs.limit(0), fit(docs.limit(0), none), ["doc_id"]).count() == 0


def test_held_out_accuracy(spark):
    got = op1_clause_grammar(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = got.join(labels, "doc_id").filter("held_out").select("toxic", "predicted").collect()
    assert sum(r.toxic == r.predicted for r in rows) / len(rows) > 0.97
    toxic, clean = [r for r in rows if r.toxic], [r for r in rows if not r.toxic]
    # The labels have noise: some toxic texts hold no word that training texts mark.
    assert sum(r.predicted for r in toxic) / len(toxic) >= 0.85
    assert sum(r.predicted for r in clean) / len(clean) <= 0.01
    assert held_out(F.lit("1")) is not None


def test_learned_curve_orders_kinds_and_unaimed_insults_are_needed(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = fit(docs, labels)
    g = Grammar(model.words, model.beginnings)
    p = {x: curve_score(model.curve, features(g.read(x))) for x in (
        "", "You are an idiot", "You are not an idiot", "She said you are an idiot", "I will kill you", "I will not kill you")}
    assert p[""] < p["You are not an idiot"] < 0.5 < p["You are an idiot"]
    assert p["She said you are an idiot"] < p["You are an idiot"]
    assert p["I will not kill you"] < 0.5 < p["I will kill you"]
    rows = (read(docs, model.words, model.beginnings, ["doc_id"]).join(labels.filter("toxic = 1"), "doc_id")
            .filter(held_out(F.col("doc_id"))).select("sums").collect())
    found = lambda sums: curve_score(model.curve, features(sums)) >= 0.5
    whole, aimed = (sum(found([r.sums[0] * use, *r.sums[1:]]) for r in rows) / len(rows) for use in (1, 0))
    assert whole >= 0.85 and aimed < 0.5
