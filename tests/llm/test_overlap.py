import random

from pyspark.sql import functions as F

from groundset.llm import overlap as O

SCHEMA = "record_id long, data_path string, image string, prompt string, page string, words string"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def pairs(spark, rows, links=(("tr", "ev"),)):
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)
    return {(r.train_id, r.eval_id) for r in O.cross_split_pairs(df, list(links)).collect()}


def test_cases(spark):
    base = "Transcribe the line inside the box [1, 20, 3, 4]."
    same = [base, "transcribe  the line inside the box (1,20, 3, 4)", "Please transcribe the lnie inside the rectangle [1, 20, 3, 4].\n", base.upper()]
    other = ["Transcribe the line inside the box [1, 21, 3, 4].", "Translate the line inside the box [1, 20, 3, 4] into German.", "Read it aloud to me now please [1, 20, 3, 4]"]
    rows = [(0, "ev", "scans/A_1.png", base)]
    rows += [(i, "tr", p, t) for i, (p, t) in enumerate([("x\\a_1.PNG", same[1]), ("A_1.jpg", same[2]), ("./A_1", same[3]), ("/m//A_1.tif", base)], 1)]
    rows += [(10 + i, "tr", "scans/A_1.png", t) for i, t in enumerate(other)] + [(20, "tr", "scans/A_2.png", base), (21, "zz", "scans/A_1.png", base), (22, "tr", None, base), (23, "tr", "scans/A_1.png", None), (24, "tr", "scans/A_1.png", "  "), (1, "tr", "x\\a_1.PNG", same[1])]
    assert pairs(spark, rows) == {(i, 0) for i in (1, 2, 3, 4)}
    assert pairs(spark, rows, ()) == set() and pairs(spark, []) == set()


def test_names_are_kept(spark):
    rows = [(0, "ev", "p.png", "How did the case of Sabin Oslaford end?"), (1, "tr", "p.png", "How did the csae of Sabin Oslaford end"), (2, "tr", "p.png", "How did the case of Sabin Oslafond end?")]
    assert pairs(spark, rows) == {(1, 0)}


def test_join_loses_nothing(spark):
    rng = random.Random(1)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(2, 5))) for _ in range(12)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 9))) for _ in range(61)]
    for t in list(texts):
        s = list(t)
        for _ in range(rng.randint(1, 4)):
            k = rng.randrange(len(s))
            s[k : k + 1] = rng.choice([[], [rng.choice("abc")], [s[k], "b"]])
            s = s or ["a"]
        texts.append("".join(s))
    rows = [(i, "ev" if i % 2 else "tr", "p.png", t) for i, t in enumerate(texts) if t.strip()]
    w = {r.i: r.w for r in spark.createDataFrame([(i, t) for i, _, _, t in rows], "i long, t string").select("i", O.wording(F.col("t")).alias("w")).collect()}
    want = {(i, j) for i, a, _, _ in rows if a == "tr" for j, b, _, _ in rows if b == "ev" and w[i] and w[j] and distance(w[i], w[j]) <= min(O.MAX_EDITS, len(w[j]) // O.CHARS_PER_EDIT)}
    assert pairs(spark, rows) == want and len(want) > 15


def test_hot_question_stays_classes(spark):
    rows = [(i, "tr", "p.png", "Transcribe the whole page.") for i in range(300)] + [(1000, "ev", "p.png", "Transcribe the whole leaf")]
    assert len(pairs(spark, rows)) == 300


def test_classes(spark):
    """Linked classes with their sizes make the same number of pairs as the records themselves."""
    rows = [(i, "tr", "p.png", "Transcribe the whole page.") for i in range(30)] + [(40, "tr", "p.png", "Transcribe the wohle page"), (50, "ev", "p.png", "transcribe the whole leaf"), (51, "ev", "p.png", "Transcribe the whole page"), (51, "ev", "p.png", "Transcribe the whole page"), (60, "ev", "q.png", "Transcribe the whole page")]
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)
    c = O.cross_split_classes(O.questions(df, [("tr", "ev")]), [("tr", "ev")]).collect()
    assert sum(r.eval_records * r.train_records for r in c) == len(pairs(spark, rows)) == 62
    assert {(r.eval_class, r.train_class, r.eval_records, r.train_records) for r in c} == {(50, 0, 2, 30), (50, 40, 2, 1)}
