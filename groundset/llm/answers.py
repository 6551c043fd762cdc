"""Problem 5: defective answers with their defect type.

Tokens of question and answer are aligned: the shingles of the answer must be contained in
the question and the longest common subsequence must cover both for a copy. A refusal is an
answer whose every sentence aligns with a refusal template or with a closing phrase. Breaks
are found from how an answer of its kind has to end, other languages by character n-gram
models of labelled texts. Each answer gets the first defect that holds, in the order of DEFECTS.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from groundset.session import small_rows, table

DEFECTS = ("empty", "refusal", "copy_of_prompt", "truncated", "other_language")
SHINGLE = 3
COPY_SHARE = 0.85
LANG_BITS = 18
LANG_ROWS = 600  # labelled texts of each language the models are fitted on
LANG_CHARS = 20_000  # longer ones aren't drawn for fitting
MAX_LANGS = 500
LEAD = 4.0  # log likelihood by which a language must lead
FLOOR = 1.5  # log likelihood a sign under the floor of a language that is none of it
#: Bare stand-ins for nothing.
STAND_INS = {"null", "none", "n/a", "na", "nil", "nan", "undefined", "empty", "void", "nothing", "no answer", "keine", "nichts", "rien", "inget", "ingenting"}
#: Names of languages, by which an answer in one is asked for.
ASKED = {"en": r"\b(?:english|englisch|anglais|engelska)\b", "de": r"\b(?:german|deutsch|allemand|tyska)\b", "fr": r"\b(?:french|französisch|français|franska)\b", "sv": r"\b(?:swedish|schwedisch|suédois|svenska)\b"}
#: Questions whose answer is read from the page, in the page's language. Several cues each, so that one misspelt word doesn't hide the kind.
READING = re.compile(
    r"\b(transcri\w*|trans\w*ri\w*e|read (?:the|this|out)|write out|every line|line by line|you can see|full text|reading order|the whole (?:page|leaf)|(?:which|what) (?:text|writing) stands|stands inside|grid"
    r"|line inside|(?:text|writing) in (?:the )?(?:box|rectangle)|copy out|transkrib\w*|abschr\w*|skriv av)\b"
)
ONE_LINE = re.compile(r"\b(line inside|inside the (?:box|rectangle)|(?:text|writing) in (?:the )?(?:box|rectangle)|stands inside|read the (?:text|writing)|grid)\b")
TRANSLATION = re.compile(r"\b(translat\w*|trans\w*te|übersetz\w*|tradui\w*|översätt\w*)\b")
#: What refusals are made of. A template is one way to say that one may or can not, with one verb of answering, in the order of the language.
CANNOT = {
    "en": "i can't|i cannot|i can not|i could not|i am unable to|i'm unable to|i am not able to|i'm not able to|i won't be able to|i will not be able to|i must decline to|i have to decline to|i do not have permission to|i don't have permission to|it is not possible for me to|it's not possible for me to|i would rather not|i'd rather not|i am not allowed to|i'm not allowed to|i won't|i will not|i must not|i refuse to",
    "de": "kann ich nicht|kann ich keine|ich kann nicht|ich kann keine|ich kann bei nicht|darf ich nicht|darf ich keine|dazu darf ich nicht|dazu darf ich keine|ich darf nicht|es ist mir nicht möglich|es ist mir nicht erlaubt",
    "fr": "je ne peux pas|je ne suis pas en mesure de|il m'est impossible de|je ne puis|je ne suis pas autorisé à|je ne suis pas autorisée à|je dois refuser de",
    "sv": "kan jag inte|jag kan inte|jag kan tyvärr inte|får jag inte|jag får inte|det går inte för mig att|jag har inte tillåtelse att|jag måste avstå från att",
}
VERBS = {
    "en": "help|assist|answer|provide|read|discuss|comment|share|transcribe|translate|describe|say|tell|do|give|reply|respond|complete|show|process|speculate|reveal|disclose|fulfil|fulfill|continue|offer|make|explain|identify|view|open|access|see",
    "de": "helfen|beantworten|antworten|lesen|auskunft|sagen|beschreiben|übersetzen|mitteilen|zeigen|besprechen|weitergeben|abschreiben|angaben|nennen|erlaubt|möglich",
    "fr": "répondre|fournir|lire|aider|dire|décrire|traduire|donner|transcrire|commenter|communiquer|partager|traiter|discuter",
    "sv": "svara|lämna|läsa|hjälpa|säga|beskriva|översätta|ge|visa|kommentera|dela|återge|diskutera|besvara",
}
WHOLE = "is beyond what i may do|is beyond what i can do|my rules do not let me|my rules don't let me|my guidelines do not let me|is not something i can do|this is outside what i can do|das ist mir nicht möglich|das darf ich nicht|cela m'est impossible|det får jag inte"
REFUSALS = [f"{c} {v}".split() for lang, cs in CANNOT.items() for c in cs.split("|") for v in VERBS[lang].split("|")] + [t.split() for t in WHOLE.split("|")]
OPENINGS = [t.split() for t in "i'm sorry but|i am sorry but|sorry but|sorry|unfortunately|i apologize but|i apologise but|i apologize|i apologise|as an assistant|as a language model|i'm afraid|i regret that|thank you for asking but|es tut mir leid aber|leider|entschuldigung|ich bedaure aber|als assistent|je suis désolé mais|je suis désolée mais|malheureusement|navré|désolé|je regrette mais|tyvärr|jag beklagar men|förlåt men|jag är ledsen men|ursäkta men".split("|")]
#: Beginnings of sentences that send the reader elsewhere or end the talk.
CLOSINGS = [t.split() for t in "please consult|please contact|please see|please ask|please try|please refer to|you may ask|you may want to|you can ask|you could ask|is there anything else|let me know|feel free to|thank you for|i hope|bitte wenden sie sich|bitte fragen sie|bitte versuchen sie|kann ich sonst|veuillez consulter|veuillez vous adresser|veuillez essayer|veuillez contacter|n'hésitez pas|fråga gärna|kontakta gärna|vänd dig till|försök gärna|vänligen".split("|")]
OPEN_WORDS = 8
_LETTERS = re.compile(r"[^\W\d_]+")
_TOKEN = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_VISIBLE = re.compile(r"[^\W_]")
_SENTENCE = re.compile(r"(?<=[.!?])\s+")
_END = re.compile(r"[.!?…][\"'»”’)\]]*$")
_TAG = re.compile(r"<(/?)([A-Za-z][\w.-]*)[^<>]*?(/?)>")
_INABILITY = re.compile(r"\b(?:can't|cannot|can not|unable|able to|decline|permission|possible|beyond|rules|rather not|allowed|kann|darf|möglich|peux|puis|mesure|impossible|inte)\b")


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.lower().replace("’", "'"))


def lcs(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, by bits of a: one big-number step for each token of b."""
    at: dict[str, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        u = row & at.get(x, 0)
        row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


def is_copy(question: list[str], answer: list[str]) -> bool:
    """Only the question, once or repeated. Whole repeats are aligned one after the other."""
    if not question or len(answer) < 2 or len(answer) < COPY_SHARE * len(question):
        return False
    n = min(SHINGLE, len(question), len(answer))
    have = {tuple(question[i : i + n]) for i in range(len(question) - n + 1)}
    times = max(1, round(len(answer) / len(question)))
    shingles = len(answer) - n + 1 - (times - 1) * (n - 1)
    held = sum(tuple(answer[i : i + n]) in have for i in range(len(answer) - n + 1))
    if held < COPY_SHARE * max(1, shingles) * 0.8:
        return False
    pattern = question * times
    common = lcs(answer, pattern) if len(answer) <= len(pattern) else lcs(pattern, answer)
    return common >= COPY_SHARE * len(answer) and common >= COPY_SHARE * len(pattern)


def _aligns(sentence: list[str], template: list[str], more: int) -> bool:
    return len(sentence) >= len(template) and len(sentence) - len(template) <= more and lcs(template, sentence) == len(template)


def is_refusal(answer: str) -> bool:
    """Every sentence aligns with a refusal, opening or closing template, and at least one with a refusal."""
    low = answer.lower().replace("’", "'")
    if not _INABILITY.search(low):
        return False
    refused = False
    for sentence in _SENTENCE.split(low.strip()):
        words = tokens(sentence)
        if not words:
            continue
        head = max((len(o) for o in OPENINGS if words[: len(o)] == o), default=0)
        have = set(words)
        if any(have.issuperset(t) and (_aligns(words[head:], t, OPEN_WORDS) or _aligns(words, t, OPEN_WORDS)) for t in REFUSALS):
            refused = True
        elif head != len(words) and not any(words[: len(t)] == t and len(words) <= len(t) + OPEN_WORDS for t in CLOSINGS):
            return False
    return refused


def is_empty(answer: str | None) -> bool:
    if answer is None or not _VISIBLE.search(answer):
        return True
    return answer.strip(" \t\r\n\"'`.()[]{}<>-–—*_").lower() in STAND_INS


def breaks_off(answer: str, question: str) -> bool:
    """The answer ends before its list, markup or sentence does."""
    text = answer.strip()
    if re.match(r"[\[{](?=[\s\d\[{\"\]}-])", text):
        return text.count("[") != text.count("]") or text.count("{") != text.count("}")
    if re.match(r"<[A-Za-z]", text):
        if text.rfind("<") > text.rfind(">"):
            return True
        opened: list[str] = []
        for close, name, alone in _TAG.findall(text):
            if close:
                if name in opened:
                    while opened.pop() != name:
                        pass
            elif not alone:
                opened.append(name)
        return bool(opened)
    if re.match(r"line \d", text) and len(text) < 40 and "\n" not in text:
        return not re.fullmatch(r"line \d+ of \d+\.?", text)
    if _END.search(text):
        return False
    if ONE_LINE.search(question) or (READING.search(question) and "\n" not in text):
        return False
    return not text.endswith((">", "]")) or text.rfind("<") > text.rfind(">")


class Languages:
    """Character n-gram models of languages; the n-grams of whole texts in lower case with single blanks."""

    def __init__(self, names: list[str], tables: np.ndarray, floors: np.ndarray) -> None:
        self.names, self.tables, self.floors = names, tables, floors

    @staticmethod
    def grams(text: str) -> np.ndarray:
        c = np.frombuffer((" " + " ".join(_LETTERS.findall(text.lower())) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
        h = c[:-2] * np.uint32(0x9E3779B1) ^ c[1:-1] * np.uint32(0x85EBCA6B) ^ c[2:] * np.uint32(0xC2B2AE35) if len(c) > 2 else c[:0]
        return ((h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - LANG_BITS)

    @classmethod
    def fit(cls, rows: list[tuple[str, str]]) -> Languages:
        """From (language, text). A floor is what nearly all texts of a language reach a sign; far below it a text is in none of them."""
        names = sorted({n for n, _ in rows})
        counts = np.zeros((len(names), 1 << LANG_BITS))
        for n, t in rows:
            counts[names.index(n)] += np.bincount(cls.grams(t), minlength=1 << LANG_BITS)
        total = np.maximum(counts.sum(axis=1, keepdims=True), 1.0)
        tables = np.log((counts + 0.1) / (total + 0.1 * (1 << LANG_BITS))).astype(np.float32)
        model = cls(names, tables, np.full(len(names), -np.inf))
        for k, name in enumerate(names):
            mean = [float(tables[k][g].mean()) for n, t in rows if n == name and len(g := cls.grams(t)) >= 40]
            model.floors[k] = np.quantile(mean, 0.01) - FLOOR if mean else -np.inf
        return model

    def of(self, text: str, least: float) -> str | None:
        """The likeliest language; '' if it is none of those known, None if another one comes nearer than ``least`` or nothing can be told."""
        g = self.grams(text)
        if len(g) < 3 or not self.names:
            return None
        sums = self.tables[:, g].sum(axis=1)
        first = int(sums.argmax())
        if len(g) >= 40 and sums[first] / len(g) < self.floors[first]:
            return ""
        rest = np.delete(sums, first)
        return self.names[first] if not len(rest) or sums[first] - rest.max() >= least else None


def fit_languages(texts: DataFrame, language: str, text: str, key: str) -> Languages:
    """Models from a bounded sample: of each language the LANG_ROWS rows of lowest hash among those of at most LANG_CHARS signs."""
    t = texts.where(F.col(language).isNotNull() & F.col(text).isNotNull() & (F.length(text) <= LANG_CHARS)).select(F.col(language).alias("l"), F.col(text).alias("t"), F.xxhash64(key).alias("h"), F.pmod(F.xxhash64(key), F.lit(64)).alias("part"))
    top = lambda df, *by: df.withColumn("r", F.row_number().over(Window.partitionBy(*by).orderBy("h", "t"))).where(F.col("r") <= LANG_ROWS)
    few = top(top(t.select("l", "h", "t", "part"), "l", "part"), "l").select("l", "t")
    return Languages.fit([(r["l"], r["t"]) for r in small_rows(few, LANG_ROWS * MAX_LANGS, "the sample of labelled texts")])


def defect(question: str | None, answer: str | None, languages: Languages | None = None) -> str | None:
    """The defect of one answer, or None. Without a question, no copy and no other language is found; without language models no other language."""
    if is_empty(answer):
        return "empty"
    assert answer is not None
    question = " ".join((question or "").lower().split())
    if is_refusal(answer):
        return "refusal"
    asked = tokens(question)
    given = tokens(answer)
    if is_copy(asked, given):
        return "copy_of_prompt"
    if breaks_off(answer, question):
        return "truncated"
    if languages is not None and question and not READING.search(question) and not TRANSLATION.search(question) and answer.lstrip()[:1] not in ("[", "<"):
        wanted = {lang for lang, p in ASKED.items() if re.search(p, question)}
        spoken = languages.of(question, LEAD)
        said = languages.of(answer, LEAD) if spoken else None
        if said is not None and said != spoken and said not in wanted:
            return "other_language"
    return None


def find_defects(pairs: DataFrame, languages: Languages | None = None) -> DataFrame:
    """(record_table, record_id, field, defect) for pairs with the columns record_table, record_id, field, question, answer.

    A null answer is empty; null ids stay null; other columns are ignored; repeated rows count once.
    """

    shared = pairs.sparkSession.sparkContext.broadcast(languages and (languages.names, languages.tables, languages.floors))  # 1 MB for each language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Languages(*shared.value) if shared.value else None
        for b in batches:
            found = [defect(q, a, known) for q, a in zip(b.column(3).to_pylist(), b.column(4).to_pylist())]
            keep = pa.array([i for i, d in enumerate(found) if d], pa.int64())
            cols = [b.column(i).take(keep) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([d for d in found if d], pa.string())], ["record_table", "record_id", "field", "defect"])

    out = pairs.select("record_table", F.col("record_id").cast("long").alias("record_id"), "field", "question", "answer")
    return out.mapInArrow(run, "record_table string, record_id long, field string, defect string").distinct()


def question_of(messages: str = "messages", prompt: str = "prompt"):
    """The prompt, else the text of the last user message."""
    users = F.filter(F.col(messages), lambda m: m["role"] == "user")
    last = F.try_element_at(users, F.lit(-1))["content"]
    said = F.array_join(F.transform(F.filter(last, lambda c: c["text"].isNotNull()), lambda c: c["text"]), " ")
    return F.coalesce(F.col(prompt), said)


def all_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    sft = table(spark, sf_dir, "sft_records").select(F.lit("sft").alias("record_table"), "record_id", F.lit("completion").alias("field"), question_of().alias("question"), F.col("completion").alias("answer"))
    dpo = table(spark, sf_dir, "dpo_records").select(F.lit("dpo").alias("record_table"), "record_id", F.explode(F.array(F.struct(F.lit("chosen").alias("field"), F.col("chosen").alias("answer")), F.struct(F.lit("rejected").alias("field"), F.col("rejected").alias("answer")))).alias("x"), F.col("prompt").alias("question"))
    return sft.unionByName(dpo.select("record_table", "record_id", "x.field", "question", "x.answer"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "documents")
    return find_defects(all_pairs(spark, sf_dir), fit_languages(texts, "lang", "text", "doc_id"))


def p5_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defective answers by table, field and defect."""
    return p5_found(spark, sf_dir).groupBy("record_table", "field", "defect").agg(F.count("*").alias("answers"))


QUERIES = {"p5_found": p5_found, "p5_report": p5_report}
