import random

import pytest

from groundset.llm import answers as A

Q = "Which payments does the clerk mention?"
CASES = [
    (Q, None, "empty"), (Q, "", "empty"), (Q, " ​\n", "empty"), (Q, "N/A", "empty"), (Q, '""', "empty"), (Q, "[]", "empty"), (Q, "-", "empty"), (None, None, "empty"),
    (Q, "Sorry — my rules do not let me read this image. Please try another page.", "refusal"), (Q, "Leider dazu darf ich keine Auskunft geben.", "refusal"), (Q, "I'm sorry, but to answer this is beyond what I may do.", "refusal"),
    (Q, 'The clerk adds: "I am sorry to refuse the lease." The reeve noted the barn.', None), (Q, "I cannot make out the third word, but the rest is clear. The reeve noted the old barn of the parish.", None),
    (Q, "  which  payments does the clerk mention?\n", "copy_of_prompt"), (Q, f"{Q} {Q}", "copy_of_prompt"), (Q, f"> {Q}", "copy_of_prompt"), (Q, f"{Q} The reeve paid the steward of the manor for the repair of the roof.", None),
    (Q, "The reeve noted the barn of the", "truncated"), ("List the boxes of all lines, in reading order.", "[[1, 2, 3, 4], [5, 6", "truncated"), ("Emit the markup of the paragraph [1, 2, 3, 4].", "<text><bold>a</text>", None), ("Emit the markup of the paragraph [1, 2, 3, 4].", "<text><bold>a</bold>", "truncated"),
    ("Read the text in box [1, 2, 3, 4].", "the barn of the", None), ("transcribe the lne inside the box [1, 2, 3, 4]", "den Garten des", None),
    (Q, "Der Müller verkaufte das Wehr mit der Zustimmung des Schreibers.", "other_language"), (Q + " Answer in German.", "Der Müller verkaufte das Wehr mit der Zustimmung des Schreibers.", None), ("Transcribe the whole page.", "Der Müller verkaufte\ndas Wehr mit der Zustimmung.", None), ("Vilka betalningar nämner skrivaren?", "The reeve noted the barn of the parish.", "other_language"),
    (Q, "The reeve paid the steward.", None), (Q, "[1, 2, 3, 4]", None), ("Where is it?", "line 4 of 4", None), (None, "The reeve paid.", None),
]


EN = "the reeve of the parish paid the steward for the repair of the roof and of the old barn beside the river with the consent of the clerk which payments does he mention in this record"
DE = "der müller verkaufte das wehr mit der zustimmung des schreibers und die gemeinde zahlte für den garten neben der kapelle welche zahlungen nennt er in diesem band und nach dem brauch"
SV = "vilka betalningar nämner skrivaren och hur mycket fick socknen för taket på den gamla ladan vid ån med samtycke av förvaltaren enligt sedvänjan i denna bok"
RNG = random.Random(4)
LANGUAGES = A.Languages.fit([(n, " ".join(RNG.sample(t.split(), 20)) + " " + t) for n, t in (("en", EN), ("de", DE), ("sv", SV)) for _ in range(40)])
LANGUAGES.floors -= 2.0  # its texts are all alike


@pytest.mark.parametrize("q,a,want", CASES)
def test_defect(q, a, want):
    assert A.defect(q, a, LANGUAGES) == want


def test_languages(spark):
    assert LANGUAGES.of("The clerk paid for the barn.", A.LEAD) == "en" and LANGUAGES.of("12 (3)", A.LEAD) is None and A.Languages.fit([]).of("the barn", A.LEAD) is None
    assert LANGUAGES.of("Секретарь упоминает о выплатах приходу за ремонт старой крыши.", A.LEAD) == ""  # none of the known ones
    assert A.defect(Q, "Секретарь упоминает о выплатах приходу за ремонт старой крыши.", LANGUAGES) == "other_language"
    rows = [(k, t, n) for k, (n, t) in enumerate([("en", EN)] * 5 + [("de", DE)] * 5 + [(None, SV), ("sv", None)])]
    fitted = A.fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "lang", "text", "doc_id")
    assert fitted.names == ["de", "en"]
    assert A.fit_languages(spark.createDataFrame([], "doc_id long, text string, lang string"), "lang", "text", "doc_id").names == []


def test_long_copies_and_refusals():
    assert A.defect(Q, " ".join([Q] * 5)) == A.defect(Q, "\n".join([Q] * 60)) == "copy_of_prompt"
    no = "Sorry — my rules do not let me read this image. Please try another page. "
    assert A.defect(Q, no) == A.defect(Q, no * 20) == "refusal"
    assert A.defect(Q, " ".join([Q] * 5) + " The reeve paid the steward of the manor for the repair of the roof and of the old barn beside the river in spring.") is None


def test_subsequence_against_brute_force():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 12))] for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert A.lcs(a, b) == t[-1][-1]


def test_long_answer_is_read_whole():
    assert A.defect(Q, "The reeve paid the steward. " * 20_000 + "And the") == "truncated"


def test_table(spark):
    rows = [("sft", 1, "completion", Q, None, "x"), ("sft", 1, "completion", Q, None, "y"), ("dpo", 2, "chosen", None, "Fine.", None), ("dpo", None, "chosen", None, "", None)]
    df = spark.createDataFrame(rows, "record_table string, record_id long, field string, question string, answer string, defect string")
    got = {(r.record_table, r.record_id, r.defect) for r in A.find_defects(df).collect()}
    assert got == {("sft", 1, "empty"), ("dpo", None, "empty")}
    assert A.find_defects(df).count() == 2 and A.find_defects(df.limit(0)).count() == 0


def test_question_of_messages(spark):
    t = "array<struct<role:string,content:array<struct<type:string,text:string,image:string>>>>"
    rows = [("p", None), (None, [("user", [("text", "a", None)]), ("user", [("image", None, "i"), ("text", "b", None)])]), (None, None), (None, []), (None, [("system", [("text", "s", None)])])]
    df = spark.createDataFrame(rows, f"prompt string, messages {t}")
    assert [r[0] for r in df.select(A.question_of()).collect()] == ["p", "b", None, None, None]
