"""One query for each rule of the markup, over documents whose findings are known.

Every customer gives one document: a sound passage as often as the key modulo 3 and a broken
one as often as the key modulo 4. The query renders, shreds and judges them; the SQL counts
what must be found from the key alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundset.functions.text import xml_text
from groundset.operators import markup
from groundset.session import table
from groundset.sources import xml

_AT = '<location value="12"/><location value="30"/><location value="480"/><location value="62"/>'
_ROWS = "<ched/>holder<ched/>rent<nl/><fcel/>Amery<fcel/>4 s.<nl/>"
#: name of the query -> (rule, what its details start with, sound passage, broken passage, findings for k broken ones, opening of the document)
CASES: dict[str, tuple[str, str, str, str, str, str]] = {
    "list_class": ("attribute_domain", "list@", '<list class="unordered"><ldiv/>one plough<ldiv/>two oxen</list>', '<list class="dashed"><ldiv/>one plough<ldiv/>two oxen</list>', "k", ""),
    "checkbox_class": ("attribute_domain", "checkbox@", '<text>paid <checkbox class="selected"/></text>', '<text>paid <checkbox class="crossed"/> owed <checkbox class="open"/></text>', "2 * k", ""),
    "layer_value": ("attribute_domain", "layer@", '<heading level="2"><layer value="furniture"/>Rents</heading>', '<heading level="2"><layer value="margin"/>Rents</heading>', "k", ""),
    "picture_class": ("attribute_domain", "picture@", '<picture class="chart"><src uri="plan.png"/></picture>', '<picture class="map"><src uri="plan.png"/></picture>', "k", ""),
    "value_class": ("attribute_domain", "value@", '<field_region><field_item><key>Date</key><value class="fillable">May</value></field_item></field_region>', '<field_region><field_item><key>Date</key><value class="typed">May</value></field_item></field_region>', "k", ""),
    "head_order": ("head_order", "", f'<text><label value="entry"/><layer value="body"/>{_AT}Item paid.</text>', f'<text><layer value="body"/><label value="entry"/>{_AT}Item paid.</text>', "k", ""),
    "one_link": ("one_link", "", '<text><href uri="https://example.org/roll"/>see the roll</text>', '<text><thread thread_id="3"/><xref thread_id="3"/><href uri="https://example.org/roll"/>see the roll</text>', "k", ""),
    "list_start": ("list_start", "", "<list><ldiv><marker>i</marker></ldiv>a weir<ldiv/>a mill</list>", "<list>a weir<ldiv/>a mill</list><list/>", "2 * k", ""),
    "table_start": ("table_start", "", f"<table>{_ROWS}</table>", f"<table>Rents{_ROWS}</table><index><text>A</text><fcel/>B<nl/></index>", "2 * k", ""),
    "text_in_group": ("no_text_here", "group", "<group>\n<heading level=\"1\">Court</heading><text>held in May</text>\n</group>", "<group>Court<text>held in May</text>again</group>", "2 * k", ""),
    "known_elements": ("known_elements", "", "<text>the <bold>reeve</bold></text>", "<text>the <strong>reeve</strong> and <mark>his <em>son</em></mark></text>", "3 * k", ""),
    "rectangular": ("rectangular", "", f"<table>{_ROWS}<fcel/>Baldwin<ecel/><nl/></table>", f"<table>{_ROWS}<fcel/>Baldwin<nl/></table>", "k", ""),
    "box_order": ("box_order", "", f"<text>{_AT}Item paid.</text>", '<text><location value="480"/><location value="30"/><location value="12"/><location value="62"/>Item paid.</text>', "k", ""),
    "location_limit": ("location_limit", "", f"<text>{_AT}Item paid.</text>", '<text><location value="12"/><location value="30"/><location value="512"/><location value="62"/>Item paid.</text>', "k", '<head><default_resolution width="512" height="768"/></head>'),
    "xref_defined": ("xref_defined", "", '<text><thread thread_id="5"/>begins</text><text><xref thread_id="5"/>goes on</text>', '<footnote><xref thread_id="55"/>goes on</footnote>', "k", ""),
    "field_item_place": ("field_item_place", "", "<field_region><text><field_item><key>Name</key></field_item></text></field_region>", "<text>Name: <field_item><key>Name</key></field_item></text>", "k", ""),
    "key_place": ("key_place", "", "<field_region><field_item><text><key>Name</key></text></field_item></field_region>", "<field_region><field_heading level=\"1\">Form</field_heading><text><key>Name</key> and <key>Place</key></text></field_region>", "2 * k", ""),
    "one_key": ("one_key", "", "<field_region><field_item><key>Name</key><field_item><key>First</key></field_item></field_item></field_region>", "<field_region><field_item><key>Name</key><text><key>Place</key></text></field_item></field_region>", "k", ""),
    "tabular_place": ("tabular_place", "", f'<picture class="chart"><tabular>{_ROWS}</tabular></picture>', f'<picture><tabular>{_ROWS}</tabular></picture><text><tabular>{_ROWS}</tabular></text>', "2 * k", ""),
    "src_first": ("src_first", "", '<picture class="undefined"><caption>The mill</caption><src uri="mill.png"/>by the ford</picture>', '<picture class="undefined"><caption>The mill</caption>by the ford<src uri="mill.png"/></picture>', "k", ""),
    "thread_host": ("thread_host", "", '<text><thread thread_id="8"/>begins</text><text><thread thread_id="8"/>ends</text>', '<heading level="1"><thread thread_id="9"/>begins</heading><text><thread thread_id="9"/>ends</text>', "least(k, 1)", ""),
    "text_before_head": ("text_before_head", "", '<caption><label value="plan"/>Plan of the mill</caption>', '<caption>Plan <label value="plan"/>of the mill</caption>', "k", ""),
    "four_locations": ("four_locations", "", f"<formula>{_AT}a + b</formula>", '<formula><location value="12"/><location value="30"/><location value="480"/>a + b</formula>', "k", ""),
    "whole_numbers": ("whole_numbers", "", '<heading level="3">Rents</heading><text><location value="0" resolution="9"/><location value="1"/><location value="2"/><location value="3"/>x</text>', '<heading level="third">Rents</heading><text><location value="-4" resolution="0"/><location value="1"/><location value="2"/><location value="3"/>x</text>', "3 * k", ""),
    "known_attributes": ("known_attributes", "", '<text>the <italic>reeve</italic></text>', '<text align="left">the <italic lang="la" class="x">prepositus</italic></text>', "2 * k", ""),
    "allowed_children": ("allowed_children", "", "<text>of <bold>old <italic>time</italic></bold></text>", "<text>of <bold>old <heading level=\"1\">time</heading></bold></text><page_break/><description/>", "2 * k", ""),
    "version": ("version", "", "<text>Rents</text>", "<text>Rents</text>", "least(k, 1)", ""),
    "well_formed": ("well_formed", "", "<text>Rents &amp; fines</text>", "<text>Rents & fines</text>", "least(k, 1)", ""),
}


def documents(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """(doc_id, content) of one case."""
    rule, _, sound, broken, _, opening = CASES[name]
    k = F.col("c_custkey") % 4
    version = F.when(k > 0, "0.6").otherwise(markup.VERSION) if rule == "version" else F.lit(markup.VERSION)
    parts = [F.lit(f'<doclang xmlns="{markup.NAMESPACE}" version="'), version, F.lit(f'">{opening}'), F.repeat(F.lit(sound), (F.col("c_custkey") % 3).cast("int")), F.lit("<text>"), xml_text(F.col("c_name")), F.lit("</text>"), F.repeat(F.lit(broken), k.cast("int")), F.lit("</doclang>")]
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("doc_id"), F.concat(*parts).alias("content"))


def _query(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rule, start, _, _, _, _ = CASES[name]
        found = markup.violations(xml.shred(documents(spark, sf_dir, name), "doc_id", "content"), (rule,))
        return found.where(F.coalesce("detail", F.lit("")).startswith(start)).groupBy("doc_id", "rule").agg(F.count("*").alias("findings"))

    return run


def _sql(name: str) -> str:
    rule, _, _, _, count, _ = CASES[name]
    return f"SELECT CAST(c_custkey AS VARCHAR) AS doc_id, '{rule}' AS rule, CAST({count} AS BIGINT) AS findings FROM (SELECT c_custkey, c_custkey % 4 AS k FROM customer) WHERE {count} > 0"


QUERIES = {f"rule_{name}": _query(name) for name in CASES}
ORACLE = {f"rule_{name}": _sql(name) for name in CASES}

#: Fixed passages for the mutations, each with what a mutation makes of its first occurrence.
_PASSAGES = ('<footnote>held in May</footnote>', '<text><thread thread_id="2"/><layer value="body"/>begins</text>', '<list class="ordered"><ldiv/>a weir</list>', '<table><fcel/>Amery<ecel/><nl/></table>', '<text><href uri="https://example.org/"/>see there</text>')


def mutated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every mutation of documents that hold the passages their customer's key says."""
    has = [F.when(F.col("c_custkey") % (i + 2) == 0, F.lit(p)).otherwise("") for i, p in enumerate(_PASSAGES)]
    docs = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("doc_id"), F.concat(F.lit("<doclang>"), *has, F.lit("</doclang>")).alias("content"))
    return markup.mutants(docs).select("doc_id", "mutation", F.md5("content").alias("content"))


def _mutated_sql() -> str:
    body = " || ".join(f"CASE WHEN c_custkey % {i + 2} = 0 THEN '{p}' ELSE '' END" for i, p in enumerate(_PASSAGES))
    first = lambda old, new: f"regexp_replace(d, '{old}', '{new}')"
    bogus = "CASE WHEN contains(d, '<layer value=\"body\"') THEN replace(d, '<layer value=\"body\"', '<layer value=\"bogus\"') ELSE replace(d, '<list class=\"ordered\"', '<list class=\"bogus\"') END"
    drop = f"CASE WHEN contains(d, '<nl/>') THEN {first('<nl/>', '')} WHEN contains(d, '<ldiv/>') THEN {first('<ldiv/>', '')} ELSE d END"
    made = {
        "swap_tag": "CASE WHEN contains(d, '<footnote>') THEN replace(replace(d, '<footnote>', '<page_header>'), '</footnote>', '</page_header>') ELSE regexp_replace(regexp_replace(d, '<text>', '<footnote>'), '</text>', '</footnote>') END",
        "bogus_value": bogus, "drop_tag": drop, "reorder_head": "replace(d, '<thread thread_id=\"2\"/><layer value=\"body\"/>', '<layer value=\"body\"/><thread thread_id=\"2\"/>')",
        "break_table": first("<ecel/>", ""), "two_links": "replace(d, '<href', '<xref thread_id=\"1\"/><href')",
    }
    rows = " UNION ALL ".join(f"SELECT doc_id, '{m}' AS mutation, {e} AS content, d FROM docs" for m, e in made.items())
    return f"WITH docs AS (SELECT CAST(c_custkey AS VARCHAR) AS doc_id, '<doclang>' || {body} || '</doclang>' AS d FROM customer) SELECT doc_id, mutation, md5(content) AS content FROM ({rows}) WHERE content <> d"


QUERIES["mutated"] = mutated
ORACLE["mutated"] = _mutated_sql()
