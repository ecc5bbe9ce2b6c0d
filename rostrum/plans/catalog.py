"""Core queries by name, with the DuckDB statement of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import asof, debates, metadata, nested, preclean, segment
from ..operators import lines as L
from ..runtime import spread, table
from ..sources import files, govinfo
from . import pipelines

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
FLAGSHIP = "speaker_segments_daily"


def query(sql: str | None = None):
    """Registers the function under its own name, with its oracle."""

    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return add


def _nodes(spark: SparkSession, folder: str) -> DataFrame:
    return nested.interval_nodes(spread(table(spark, folder, "raw_xml").select("xml_id", "mods_xml")), "xml_id", "mods_xml").withColumnRenamed("id", "xml_id")


def _kind(spark: SparkSession, folder: str, kind: str, attributes: list[str], text: str | None = None) -> DataFrame:
    nodes = _nodes(spark, folder).withColumnRenamed("xml_id", "id")
    return nested.kind_table(nodes, kind, attributes, text).withColumnRenamed("id", "xml_id")


@query()
def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return _nodes(spark, folder).select("xml_id", "kind", "node_no", "parent_no")


@query()
def p2_items(spark: SparkSession, folder: str) -> DataFrame:
    return _kind(spark, folder, "item", ["ID"])


@query()
def p2_members(spark: SparkSession, folder: str) -> DataFrame:
    return _kind(spark, folder, "member", ["role", "bioGuideId", "chamber", "congress", "party", "state"])


@query()
def p2_names(spark: SparkSession, folder: str) -> DataFrame:
    return _kind(spark, folder, "name", ["type"], "name")


@query()
def p2_bills(spark: SparkSession, folder: str) -> DataFrame:
    return _kind(spark, folder, "bill", ["congress", "context", "number", "type"])


# --- the reference's operators over whole tables ------------------------------

#: Python's white space in SQL.
_TRIMMED = "' ' || " + " || ".join(f"chr({i})" for i in [*range(9, 14), *range(28, 32), 133, 160, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288])
_DOCS = "select doc_id, text from documents where text is not null"


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents").select("doc_id", "text").where("text is not null"))


def _speech_texts(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "parsed_crecb_speeches").select("speech_id", "speech").where("speech is not null"))


_LINES = """lines as (
    select doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 as line_no, unnest(string_split(text, chr(10))) as line
    from documents where text is not null)"""


@query(
    f"""with {_LINES}
    select doc_id, cast(line_no as integer) as line_no, cast(length(line) as integer) as n_chars,
           cast(coalesce(sum(length(line) + 1) over (partition by doc_id order by line_no rows between unbounded preceding and 1 preceding), 0) as bigint) as start
    from lines"""
)
def line_offsets(spark: SparkSession, folder: str) -> DataFrame:
    lines = L.with_offsets(L.explode_lines(_documents(spark, folder), ["doc_id"], "text"), ["doc_id"])
    return lines.select("doc_id", "line_no", F.length("line").alias("n_chars"), F.col("start").cast("bigint").alias("start"))


@query(
    f"""with {_LINES},
    marked as (select *, case when line_no % 7 = 3 then '=====' || line else line end as l from lines),
    counted as (select *, sum(case when regexp_matches(l, '^[ \\t]*={{5,}}') then 1 else 0 end) over (partition by doc_id order by line_no rows between unbounded preceding and current row) as n from marked)
    select doc_id, cast(line_no as integer) as line_no, l as line from counted where n % 2 = 0 or regexp_matches(l, '^[ \\t]*={{5,}}')"""
)
def note_block_strip(spark: SparkSession, folder: str) -> DataFrame:
    """Every seventh line is made a note marker, so that the operator has blocks to strip."""
    lines = L.explode_lines(_documents(spark, folder), ["doc_id"], "text")
    marked = lines.withColumn("line", F.when(F.col("line_no") % 7 == 3, F.concat(F.lit("====="), "line")).otherwise(F.col("line")))
    return L.strip_notes(marked, ["doc_id"])


def _rows_of(df: DataFrame, text: str, function, column: str, kind: str) -> DataFrame:
    """``df`` with what a function of the segmenter makes of each text."""
    made = F.pandas_udf(kind)(_texts_mapped(function))
    return df.select("doc_id", made(F.col(text)).alias(column))


def _texts_mapped(function):
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(function)

    return run


@query(
    f"""with {_LINES.replace("(text", "(replace(text, chr(12), chr(10))")},
    marked as (select *, case when line_no % 7 = 3 then '=====' || line else line end as l from lines),
    counted as (select *, sum(case when regexp_matches(l, '^[ \\t]*={{5,}}') then 1 else 0 end) over (partition by doc_id order by line_no rows between unbounded preceding and current row) as n,
        max(line_no) over (partition by doc_id) as last from marked)
    select doc_id, coalesce(string_agg(l || case when line_no < last then chr(10) else '' end, '' order by line_no)
        filter (where n % 2 = 0 or regexp_matches(l, '^[ \\t]*={{5,}}')), '') as kept from counted group by doc_id"""
)
def segment_notes(spark: SparkSession, folder: str) -> DataFrame:
    """What the segmenter keeps of texts in which every seventh line is a note marker (form feeds taken for line feeds)."""
    lines = F.transform(F.split(F.translate("text", "\f", "\n"), "\n"), lambda x, i: F.when(i % 7 == 3, F.concat(F.lit("====="), x)).otherwise(x))
    marked = _documents(spark, folder).withColumn("text", F.array_join(lines, "\n"))
    return _rows_of(marked, "text", segment.without_notes, "kept", "string")


@query(
    r"""select doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
        text, '\([^)]*asked and was given permission[^)]*\)[\s\x0b\x1c-\x1f\x{85}\x{a0}]*', '', 'g'), '[-_]{3,}', '', 'g'), '\{time\}[\s\x0b\x1c-\x1f\x{85}\x{a0}]*[0-9]{2,4}', '', 'g'),
        '\[Roll[^\]\r\n]*\]', '', 'g'), '\[\[Page [A-Za-z0-9]{1,10}\]\]', '', 'g'), '(?is)<title>.*?</title>', '', 'g'), '</?[^>]+>', '', 'g') as cleaned
    from documents where text is not null"""
)
def segment_clean(spark: SparkSession, folder: str) -> DataFrame:
    """The segmenter's own cleaning of whole texts."""
    return _rows_of(_documents(spark, folder), "text", segment.clean, "cleaned", "string")


@query(
    f"""with l0 as (select doc_id, unnest(string_split(replace(text, chr(12), chr(10)), chr(10))) as line, generate_subscripts(string_split(replace(text, chr(12), chr(10)), chr(10)), 1) - 1 as n from documents where text is not null),
    l1 as (select doc_id, n, case n % 11 when 5 then '' when 6 then '      ' || line when 8 then repeat(' ', 16) || 'May ' || n || ', 1999.' else line end as line from l0),
    l2 as (select *, coalesce(sum(length(line) + 1) over (partition by doc_id order by n rows between unbounded preceding and 1 preceding), 0) as place,
        lag(line) over (partition by doc_id order by n) as before, length(regexp_extract(line, '^[ \\t]*')) as lead_n, length(regexp_replace(regexp_extract(line, '^[ \\t]*'), '[^\\t]', '', 'g')) as tabs,
        regexp_extract_all(line, '[\\p{{L}}\\p{{N}}_][\\p{{L}}\\p{{N}}_''-]*') as words, trim(line, ' ' || chr(9) || chr(11) || chr(13) || chr(160)) as body from l1),
    l3 as (select *, trim(before, ' ' || chr(9) || chr(11) || chr(13) || chr(160)) = '' as below from l2)
    select doc_id, cast(place as integer) as place, 3 as kind from l3 where below and body <> '' and lead_n + tabs > 2 and len(words) > 0
        and len(list_filter(words, lambda w: regexp_matches(w, '^\\p{{Lu}}'))) * 2 >= len(words)
    union all select doc_id, cast(place as integer), 4 from l3 where body <> '' and lead_n + tabs * 14 >= 15 and regexp_matches(body, '[0-9]{{1,2}}, [0-9]{{4}}\\.?$')"""
)
def segment_line_ends(spark: SparkSession, folder: str) -> DataFrame:
    """The indented titles (3) and right-justified dates (4) that the segmenter sees, some put in by their number (form feeds taken for line feeds)."""

    def varied(x, i):
        date = F.concat(F.repeat(F.lit(" "), F.lit(16)), F.lit("May "), i.cast("string"), F.lit(", 1999."))
        return F.when(i % 11 == 5, F.lit("")).when(i % 11 == 6, F.concat(F.lit("      "), x)).when(i % 11 == 8, date).otherwise(x)

    text = F.array_join(F.transform(F.split(F.translate("text", "\f", "\n"), "\n"), varied), "\n")
    found = _rows_of(_documents(spark, folder).withColumn("text", text), "text", _line_ends, "ends", "array<struct<place:int, kind:int>>")
    return found.select("doc_id", F.explode("ends").alias("e")).select("doc_id", "e.place", "e.kind")


def _line_ends(text: str) -> list[dict]:
    return [{"place": place, "kind": kind} for place, kind in segment.line_ends(text)]


def _label_oracle(key: str, text: str, rows: str, label: str) -> str:
    label = label.replace("'", "''").replace("\\s", "[\\s\\x0b]").replace("\u2019", "\u2019")
    return f"""with t as (select {key}, regexp_extract_all(replace({text}, chr(160), ' '), '(?m){label}') as labels from {rows} where {text} is not null and not contains({text}, '====='))
    select {key}, cast(i as integer) as speech_no, rtrim(trim(labels[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '.') as speaker
    from t, unnest(range(1, len(labels) + 1)) as u(i)"""


@query(_label_oracle("doc_id", "text", "documents", segment.DIALECTS["daily"].label.pattern))
def segment_labels_daily(spark: SparkSession, folder: str) -> DataFrame:
    """The labels of the segmenter in order, without notes."""
    return segment.segment(_documents(spark, folder).where(~F.col("text").contains("=====")), "doc_id", "text", "daily").select("doc_id", "speech_no", "speaker")


@query(_label_oracle("speech_id", "speech", "(select speech_id, replace(speech, '-', '~') as speech from parsed_crecb_speeches)", segment.DIALECTS["bound"].label.pattern))
def segment_labels_bound(spark: SparkSession, folder: str) -> DataFrame:
    """The same in the bound dialect, hyphens replaced, so that no label is broken by one."""
    s = _speech_texts(spark, folder).withColumn("speech", F.replace("speech", F.lit("-"), F.lit("~"))).where(~F.col("speech").contains("====="))
    return segment.segment(s, "speech_id", "speech", "bound").select("speech_id", "speech_no", "speaker")


def _speech_oracle(key: str, rows: str, label: str) -> str:
    """Labels by one pattern over the text, marker lines (of LF) and line ends (of LF or form feed), each speech up to the next of them."""
    label = label.replace("'", "''").replace("\\s", "[\\s\\x0b]")
    cleaned = "substring(t, cast(stop + 1 as bigint), cast(greatest(stop, coalesce(following, length(t))) - stop as bigint))"
    cleaned = f"trim({cleaned}, {_TRIMMED})"
    for pattern in T.EXTRANEOUS:
        pattern = pattern.replace(T.SPACE, r"[\s\x0b\x1c-\x1f\x{85}\x{a0}]")
        cleaned = f"regexp_replace({cleaned}, '{pattern}', '', 'g')"
    return rf"""with d as (select {key}, replace(text, chr(160), ' ') as t from {rows} where text is not null and not contains(text, '=====')),
    k as (select {key}, t, regexp_extract_all(t, '(?m){label}') as labels, regexp_split_to_array(t, '(?m){label}') as parts from d),
    lab as (select {key}, t, i, labels[i] as label, list_sum(list_transform(parts[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(labels[1:i - 1], lambda x: length(x))), 0) as start
        from k, unnest(range(1, len(labels) + 1)) as u(i)),
    l0 as (select {key}, unnest(string_split(replace(t, chr(12), chr(10)), chr(10))) as line, generate_subscripts(string_split(replace(t, chr(12), chr(10)), chr(10)), 1) as n from d),
    l1 as (select *, coalesce(sum(length(line) + 1) over (partition by {key} order by n rows between unbounded preceding and 1 preceding), 0) as place, trim(line, {_TRIMMED}) as body,
        length(regexp_extract(line, '^[ \t]*')) as lead_n, length(regexp_replace(regexp_extract(line, '^[ \t]*'), '[^\t]', '', 'g')) as tabs, regexp_extract_all(line, '[\p{{L}}\p{{N}}_][\p{{L}}\p{{N}}_''-]*') as words from l0),
    l2 as (select *, lag(body) over (partition by {key} order by n) = '' as below from l1),
    m0 as (select {key}, unnest(string_split(t, chr(10))) as line, generate_subscripts(string_split(t, chr(10)), 1) as n from d),
    m1 as (select *, coalesce(sum(length(line) + 1) over (partition by {key} order by n rows between unbounded preceding and 1 preceding), 0) as place from m0),
    ev as (select {key}, place from m1 where regexp_matches(line, '^[ _-]*_{{3,}}[ _-]*$') or regexp_matches(line, '^[ _-]*-{{3,}}[ _-]*$') or regexp_matches(line, '^\[Congressional Record Volume.*\]$')
        union all select {key}, place from l2 where below and body <> '' and lead_n + tabs > 2 and len(words) > 0 and len(list_filter(words, lambda w: regexp_matches(w, '^\p{{Lu}}'))) * 2 >= len(words)
        union all select {key}, place from l2 where body <> '' and lead_n + tabs * 14 >= 15 and regexp_matches(body, '[0-9]{{1,2}}, [0-9]{{4}}\.?$')),
    nx as (select {key}, i, min(place) as marked from lab join ev using ({key}) where place >= start group by {key}, i),
    sp as (select lab.*, start + length(label) as stop, least(marked, lead(start) over (partition by lab.{key} order by lab.i)) as following from lab left join nx on nx.{key} = lab.{key} and nx.i = lab.i)
    select {key}, cast(i as integer) as speech_no, rtrim(trim(label, {_TRIMMED}), '.') as speaker, trim({cleaned}, {_TRIMMED}) as speech, cast(start as integer) as place from sp"""


@query(_speech_oracle("doc_id", "documents", segment.DIALECTS["daily"].label.pattern))
def speaker_segments_daily(spark: SparkSession, folder: str) -> DataFrame:
    return segment.segment(_documents(spark, folder), "doc_id", "text", "daily")


@query(ORACLES["speaker_segments_daily"])
def speaker_segments_sql(spark: SparkSession, folder: str) -> DataFrame:
    """The same by the table function, from SQL."""
    segment.register(spark)
    _documents(spark, folder).createOrReplaceTempView("_rostrum_documents")
    return spark.sql("select d.doc_id, s.speech_no, s.speaker, s.speech, s.place from _rostrum_documents d, lateral scrape_speeches(d.text, 'daily') s")


@query(_speech_oracle("speech_id", "(select speech_id, translate(speech, '-' || chr(12), '~' || chr(10)) as text from parsed_crecb_speeches)", segment.DIALECTS["bound"].label.pattern))
def segment_speeches_bound(spark: SparkSession, folder: str) -> DataFrame:
    """Whole speeches in the bound dialect, hyphens (so that no label is broken by one) and form feeds replaced."""
    s = _speech_texts(spark, folder).select("speech_id", F.translate("speech", "-\f", "~\n").alias("text")).where(~F.col("text").contains("====="))
    return segment.segment(s, "speech_id", "text", "bound")


@query()
def speaker_segments_bound(spark: SparkSession, folder: str) -> DataFrame:
    return segment.segment(_speech_texts(spark, folder), "speech_id", "speech", "bound")


_RE_LABEL = (
    r"^ {1,2}((?:M(?:r|rs|s)[.,]|Miss|Chairman|Chairwoman|HON\.|Hon|Dr\.) (?:[A-Z]\. )*[A-Z][a-z]{0,3}[A-Za-z''’]+(?: [A-Z][a-z]{0,3}[A-Za-z''’]+)*"
    r"(?: of [A-Z][a-zA-Z]+(?: [A-Z][a-zA-Z]+)*)?)\."
)


@query(
    f"""with {_LINES},
    placed as (select *, coalesce(sum(length(line) + 1) over (partition by doc_id order by line_no rows between unbounded preceding and 1 preceding), 0) as start from lines),
    named as (select *, regexp_extract(line, '{_RE_LABEL}', 1) as speaker, length(regexp_extract(line, '{_RE_LABEL}', 0)) as n from placed),
    spans as (select *, lead(start) over (partition by doc_id order by start) as following from named where speaker <> '')
    select s.doc_id, cast(start as bigint) as start, speaker,
           trim(substring(d.text, cast(start + n + 1 as bigint), cast(coalesce(following, length(d.text)) - start - n as bigint)), ' ' || chr(10)) as speech
    from spans s join documents d using (doc_id)"""
)
def speaker_segments_line(spark: SparkSession, folder: str) -> DataFrame:
    return L.line_speeches(_documents(spark, folder), "doc_id", "text").withColumn("start", F.col("start").cast("bigint"))


def _varied(lines: DataFrame) -> DataFrame:
    """Lines with end markers put in by their number, so that every kind occurs."""
    n, line = F.col("line_no") % 11, F.col("line")
    return lines.withColumn(
        "line",
        F.when(n == 2, F.lit("  ____  "))
        .when(n == 4, F.concat(F.lit("[Congressional Record Volume "), line, F.lit("]")))
        .when(n == 5, F.lit(""))
        .when(n == 6, F.concat(F.lit("      "), line))
        .when(n == 8, F.concat(F.repeat(F.lit(" "), F.lit(16)), F.lit("May "), F.col("line_no").cast("string"), F.lit(", 1999.")))
        .otherwise(line),
    )


@query(
    f"""with {_LINES},
    v as (select doc_id, line_no, case line_no % 11 when 2 then '  ____  ' when 4 then '[Congressional Record Volume ' || line || ']' when 5 then ''
            when 6 then '      ' || line when 8 then repeat(' ', 16) || 'May ' || line_no || ', 1999.' else line end as line from lines),
    p as (select *, lag(line) over (partition by doc_id order by line_no) as before, length(regexp_extract(line, '^[ \\t]*')) as lead_n,
            length(regexp_replace(regexp_extract(line, '^[ \\t]*'), '[^\\t]', '', 'g')) as tabs,
            regexp_extract_all(line, '[\\p{{L}}\\p{{N}}_][\\p{{L}}\\p{{N}}_''-]*') as words from v),
    m as (select doc_id, line_no, line,
            regexp_matches(line, '^[ _-]*_{{3,}}[ _-]*$') or regexp_matches(line, '^[ _-]*-{{3,}}[ _-]*$') as rule,
            regexp_matches(line, '^\\[Congressional Record Volume.*\\]$') as header,
            regexp_matches(line, '^[ \\t]*={{5,}}') as note,
            coalesce(trim(before, ' ' || chr(9) || chr(13) || chr(12) || chr(160)) = '' and lead_n + tabs > 2 and len(words) > 0
              and len(list_filter(words, lambda w: regexp_matches(w, '^\\p{{Lu}}'))) * 2 >= len(words), false) as title,
            lead_n + tabs * 14 >= 15 and regexp_matches(rtrim(line, ' ' || chr(9) || chr(13) || chr(12) || chr(160)), '[0-9]{{1,2}}, [0-9]{{4}}\\.?$') as date from p)
    select doc_id, cast(line_no as integer) as line_no, rule, header, note, title, date from m where rule or header or note or title or date"""
)
def end_markers(spark: SparkSession, folder: str) -> DataFrame:
    lines = _varied(L.explode_lines(_documents(spark, folder), ["doc_id"], "text"))
    return L.end_markers(lines, ["doc_id"]).drop("line")


@query(
    r"""select doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
        text, '\([^)]*asked and was given permission[^)]*\)[\s\x0b\x1c-\x1f\x{85}\x{a0}]*', '', 'g'), '[-_]{3,}', '', 'g'), '\{time\}[\s\x0b\x1c-\x1f\x{85}\x{a0}]*[0-9]{2,4}', '', 'g'),
        '\[Roll[^\]\r\n]*\]', '', 'g'), '\[\[Page [A-Za-z0-9]{1,10}\]\]', '', 'g'), '(?is)<title>.*?</title>', '', 'g'), '</?[^>]+>', '', 'g') as cleaned
    from documents where text is not null"""
)
def extraneous_clean(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder).select("doc_id", T.clean_extraneous("text").alias("cleaned"))


@query(
    """select speech_id, replace(translate(translate(speech, chr(160) || chr(8201) || chr(8239) || chr(8199) || '’‘“”', '    ''''""'),
        '—–' || chr(8203) || chr(8204) || chr(8205) || chr(173) || chr(8209) || chr(65279) || chr(8288), '--'), '…', '...') as normalized
    from parsed_crecb_speeches where speech is not null"""
)
def ocr_char_normalize(spark: SparkSession, folder: str) -> DataFrame:
    return _speech_texts(spark, folder).select("speech_id", T.normalize_line(T.normalize_characters("speech")).alias("normalized"))


def _judged(spark: SparkSession, folder: str) -> DataFrame:
    return preclean.reasons(preclean.text_lines(_speech_texts(spark, folder), ["speech_id"], "speech"), ["speech_id"])


@query()
def preclean_removed(spark: SparkSession, folder: str) -> DataFrame:
    return preclean.removed(_judged(spark, folder), ["speech_id"])


_DATE_LIST = ", ".join(f"'{w}'" for w in ["CONGRESSIONAL", "RECORD", *preclean.DATE_WORDS])


@query(
    rf"""with t as (select speech_id, replace(translate(speech, chr(160) || chr(8201) || chr(8239) || chr(8199) || '’‘“”' || chr(65279) || chr(8288) || chr(8206) || chr(8207) || chr(8234) || chr(8235) || chr(8236) || chr(8237) || chr(8238), '    ' || chr(39) || chr(39) || chr(34) || chr(34)), '…', '...') as s
        from parsed_crecb_speeches where speech is not null),
    p as (select speech_id, case when s = '' then [] else string_split(regexp_replace(regexp_replace(s, '\r\n|[\r\x0b\x0c\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]', chr(10), 'g'), '\n$', ''), chr(10)) end as parts from t),
    l as (select speech_id, i - 1 as n, translate(parts[i], '—–' || chr(8203) || chr(8204) || chr(8205) || chr(173) || chr(8209), '--') as line from p, unnest(range(1, len(parts) + 1)) as u(i)),
    b as (select *, trim(line, {_TRIMMED}) as bare from l),
    r as (select *, case when regexp_matches(bare, '^[0-9]{{4}}$') and try_cast(bare as integer) between 1873 and 1994 then 'hdr_year_1873_1994'
        when contains(upper(bare), 'CONGRESSIONAL RECORD') and len(list_filter(regexp_extract_all(upper(line), '[A-Z]+'), lambda w: w not in ({_DATE_LIST}))) = 0 then 'hdr_contains_CONGRESSIONAL_RECORD' end as reason from b)
    select speech_id, cast(n as integer) as line_no, reason, line as removed_line from r where reason is not null"""
)
def preclean_heads(spark: SparkSession, folder: str) -> DataFrame:
    """Lines removed as years or as headings with the record's name."""
    return preclean_removed(spark, folder).where("reason in ('hdr_year_1873_1994', 'hdr_contains_CONGRESSIONAL_RECORD')")


@query()
def preclean_summary(spark: SparkSession, folder: str) -> DataFrame:
    return preclean.summary(_judged(spark, folder))


@query()
def preclean_text(spark: SparkSession, folder: str) -> DataFrame:
    return preclean.precleaned(_judged(spark, folder), ["speech_id"])


_SPEECH_LINES = """lines as (
    select speech_id, generate_subscripts(string_split(speech, chr(10)), 1) - 1 as line_no, unnest(string_split(speech, chr(10))) as line
    from parsed_crecb_speeches where speech is not null)"""


@query(
    f"""with {_SPEECH_LINES}
    select speech_id, cast(line_no as integer) as line_no from lines
    where len(list_filter(range(1, length(line) - 17), lambda i: levenshtein(regexp_replace(substring(upper(line), i, 19), '[^A-Z ]', '', 'g'), 'CONGRESSIONAL RECORD') <= 1)) > 0
       or len(list_filter(range(1, length(line) - 18), lambda i: levenshtein(regexp_replace(substring(upper(line), i, 20), '[^A-Z ]', '', 'g'), 'CONGRESSIONAL RECORD') <= 1)) > 0
       or len(list_filter(range(1, length(line) - 19), lambda i: levenshtein(regexp_replace(substring(upper(line), i, 21), '[^A-Z ]', '', 'g'), 'CONGRESSIONAL RECORD') <= 1)) > 0"""
)
def fuzzy_header_lev1(spark: SparkSession, folder: str) -> DataFrame:
    lines = L.explode_lines(_speech_texts(spark, folder), ["speech_id"], "speech")
    return lines.where(preclean.nearly_contains_record(F.col("line"))).select("speech_id", "line_no")


@query(
    f"""with {_LINES}, p as (select *, coalesce(sum(length(line) + 1) over (partition by doc_id order by line_no rows between unbounded preceding and 1 preceding), 0) as start from lines),
    marked as (select doc_id, start, case when line_no % 5 = 1 then case when line_no % 2 = 1 then 'H' else 'S' end end as chamber from p)
    select doc_id, cast(start as bigint) as start, last_value(chamber ignore nulls) over (partition by doc_id order by start rows between unbounded preceding and current row) as chamber from marked"""
)
def chamber_asof(spark: SparkSession, folder: str) -> DataFrame:
    """Every fifth line is taken for a chamber's heading; each line gets the last heading at or before it."""
    lines = L.with_offsets(L.explode_lines(_documents(spark, folder), ["doc_id"], "text"), ["doc_id"])
    places = lines.select("doc_id", F.col("start").cast("bigint").alias("start"))
    marks = lines.where("line_no % 5 = 1").select(
        "doc_id", F.col("start").cast("bigint").alias("start"), F.when(F.col("line_no") % 2 == 1, "H").otherwise("S").alias("chamber")
    )
    return asof.asof_backward(places, marks, ["doc_id"], "start", ["chamber"])


@query(
    """with d as (select doc_id, package_id, length(text) as n from documents where text is not null and package_id is not null),
    f as (select *, coalesce(sum(n) over (partition by package_id order by doc_id rows between unbounded preceding and 1 preceding), 0) as first from d)
    select package_id, doc_id, cast(first + n // 2 as bigint) as place, (select max(g.first) from f g where g.package_id = f.package_id and g.first <= f.first + f.n // 2)::bigint as file_start from f"""
)
def source_file_asof(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of a package lie one behind the other; the middle of each is led back to where its file begins."""
    d = table(spark, folder, "documents").where("text is not null and package_id is not null").select("package_id", "doc_id", F.length("text").alias("n"))
    before = W.partitionBy("package_id").orderBy("doc_id").rowsBetween(W.unboundedPreceding, -1)
    d = d.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("bigint"))
    middles = d.select("package_id", "doc_id", (F.col("first") + F.floor(F.col("n") / 2)).cast("bigint").alias("place"))
    marks = d.select("package_id", F.col("first").alias("place"), F.col("first").alias("file_start"))
    return asof.asof_backward(middles, marks, ["package_id"], "place", ["file_start"])


@query(
    """with m as (select parsed_name, arg_max({'b': coalesce(bioguideid, ''), 'f': coalesce(full_name, ''), 'p': coalesce(party, ''), 's': coalesce(state, '')},
            coalesce(bioguideid, '') || '|' || coalesce(full_name, '') || '|' || coalesce(party, '')) as r
        from mods_members where parsed_name is not null group by parsed_name)
    select speech_id, coalesce(speaker, '') as speaker, coalesce(r.b, '') as bioguideid, coalesce(r.f, '') as full_name, coalesce(r.p, '') as party, coalesce(r.s, '') as state,
        case when speaker like 'Ms.%' or speaker like 'Mrs.%' then 'F' when speaker like 'Mr.%' then 'M' else '' end as inferred_gender
    from parsed_crecb_speeches left join m on speaker = parsed_name"""
)
def speaker_metadata_join(spark: SparkSession, folder: str) -> DataFrame:
    blank = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("bioguideid", "full_name", "party", "state")]
    members = table(spark, folder, "mods_members").where("parsed_name is not null").select("parsed_name", *blank)
    members = members.withColumn("_o", F.concat_ws("|", "bioguideid", "full_name", "party"))
    members = asof.last_per_key(members, "parsed_name", ["_o"]).drop("_o")
    speeches = table(spark, folder, "parsed_crecb_speeches").select("speech_id", "speaker")
    joined = speeches.join(members, F.col("speaker") == F.col("parsed_name"), "left")
    filled = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("speaker", "bioguideid", "full_name", "party", "state")]
    return joined.select("speech_id", *filled, F.coalesce(T.gender("speaker"), F.lit("")).alias("inferred_gender"))


def _ordered_speeches(spark: SparkSession, folder: str) -> DataFrame:
    """Speeches in the order of their file name; reloaded rows are told apart by their id."""
    s = table(spark, folder, "parsed_crecb_speeches").where("filename is not null").select("speech_id", "filename", "folder", "speech_no", "speech")
    return s.withColumn("_order", F.row_number().over(W.partitionBy("filename").orderBy("folder", "speech_no", "speech_id")))


#: Python's white space, for trimming and as a class.
_BLANKS = _TRIMMED
_BLANK = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

_TITLES = rf"""sp as (select *, row_number() over (partition by filename order by folder, speech_no, speech_id) as o from parsed_crecb_speeches where filename is not null),
    fl as (select filename, string_agg(coalesce(speech, '') || chr(10) || chr(10), '' order by o) as text from sp group by filename),
    l0 as (select filename, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as n from fl),
    l1 as (select *, coalesce(sum(length(line) + 1) over (partition by filename order by n rows between unbounded preceding and 1 preceding), 0) as start, trim(line, {_BLANKS}) as body from l0),
    l2 as (select *, length(regexp_replace(body, '[^A-Za-z]', '', 'g')) as letters, list_filter(regexp_split_to_array(body, '{_BLANK}+'), lambda w: w <> '') as ws, regexp_replace(lower(line), '[^a-z]', '', 'g') as plain from l1),
    l3 as (select *, regexp_replace(array_to_string(list_filter(ws, lambda w: lower(regexp_replace(w, '[^A-Za-z]', '', 'g')) <> 'report'), ' '), '[^A-Za-z]', '', 'g') as said,
        len(list_filter(ws, lambda w: regexp_matches(w, '[A-Za-z]'))) as lettered,
        len(list_filter(list_transform(ws, lambda w: trim(w, ',.;:!?—–-()[]{{}}<>"`' || chr(39))), lambda w: length(regexp_replace(w, '[^A-Za-z]', '', 'g')) >= 2 and not regexp_matches(w, '[a-z]'))) as caps,
        list_distinct(regexp_extract_all(lower(line), '[a-z]+')) as low from l2),
    l4 as (select *, letters >= 8 and length(said) > 0 and length(regexp_replace(said, '[^A-Z]', '', 'g')) >= 0.6 * length(said) as looks,
        contains(plain, 'congressionalrecord') or plain in ('usgovernment', 'usgoverment')
        or (len(low) > 0 and len(list_filter(low, lambda w: w not in ('gpo', 'authenticated', 'authentication', 'authentic', 'information'))) = 0) as boiler from l3),
    l5 as (select *, first_value(case when body <> '' then looks end ignore nulls) over (partition by filename order by n rows between 1 following and unbounded following) as ahead from l4),
    l6 as (select *, case when body = '' then case when coalesce(ahead, false) then 'K' else 'N' end when boiler then 'N' when lettered >= 2 and looks then 'S' when lettered = 1 and caps > 0 then 'K' else 'N' end as kind from l5),
    l7 as (select *, coalesce(last_value(case when kind <> 'K' then kind end ignore nulls) over (partition by filename order by n rows between unbounded preceding and current row) = 'S', false) as inside from l6),
    l8 as (select *, inside and not coalesce(lag(inside) over (partition by filename order by n), false) as begins from l7),
    l9 as (select *, sum(case when begins then 1 else 0 end) over (partition by filename order by n rows between unbounded preceding and current row) as block from l8),
    bl as (select filename, block, string_agg(line, chr(10) order by n) || chr(10) as title, min(start) as first, max(start + length(line) + 1) as last from l9 where inside group by filename, block),
    sec as (select filename, trim(title, {_BLANKS}) as title, last as start, coalesce(lead(first) over (partition by filename order by first), length(text)) as "end"
        from bl join fl using (filename) where not regexp_matches(title, '^{_BLANK}*(?:Mr|Ms|Mrs)\.'))"""


@query(f"""with {_TITLES} select filename, title, cast(start as integer) as start, cast("end" as integer) as "end" from sec""")
def title_sections(spark: SparkSession, folder: str) -> DataFrame:
    files, _ = debates.reconstruct(_ordered_speeches(spark, folder), "filename", "_order", "speech")
    return debates.sections(debates.titles(files, "filename"), files, "filename")


@query(
    rf"""with {_TITLES},
    st as (select *, coalesce(sum(length(coalesce(speech, '')) + 2) over (partition by filename order by o rows between unbounded preceding and 1 preceding), 0) as at from sp),
    ti as (select st.speech_id, st.filename, st.speech, case when st.at < sec."end" then coalesce(sec.title, '') else '' end as title
        from st asof left join sec on st.filename = sec.filename and st.at >= sec.start)
    select speech_id, filename, title, case when title = '' or speech is null then speech else array_to_string(list_filter(
        string_split(regexp_replace(regexp_replace(speech, '\r\n|[\r\x0b\x0c\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]', chr(10), 'g'), '\n$', ''), chr(10)),
        lambda x: not starts_with(upper(trim(regexp_replace(x, '{_BLANK}+', ' ', 'g'))), upper(trim(regexp_replace(title, '{_BLANK}+', ' ', 'g'))))), chr(10)) end as speech from ti"""
)
def title_assignment(spark: SparkSession, folder: str) -> DataFrame:
    return debates.assign_titles(_ordered_speeches(spark, folder), "filename", "_order", "speech").select("speech_id", "filename", "title", "speech")


#: Line ends of all kinds as line feeds, none at the end.
_UNIVERSAL = r"""regexp_replace(regexp_replace(text, '\r\n|[\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]', chr(10), 'g'), '\n$', '')"""


@query(
    f"""with t as (select doc_id, text, upper(trim(regexp_replace(string_split(text, chr(10))[1], '[\\s\\x0b\\x{{a0}}]+', ' ', 'g'))) as title, string_split({_UNIVERSAL}, chr(10)) as parts
        from documents where text is not null)
    select doc_id, case when title = '' then text else array_to_string(
        list_filter(parts, lambda x: not starts_with(upper(trim(regexp_replace(x, '[\\s\\x0b\\x{{a0}}]+', ' ', 'g'))), title)), chr(10)) end as body from t"""
)
def strip_assigned_title(spark: SparkSession, folder: str) -> DataFrame:
    """A document's first line taken for its title."""
    d = _documents(spark, folder).withColumn("title", T.strip(F.element_at(F.split("text", "\n"), 1)))
    return d.select("doc_id", T.without_title("text", "title").alias("body"))


@query(
    r"""with f as (select distinct filename from parsed_crecb_speeches where filename is not null),
    d as (select filename, try_strptime(regexp_extract(filename, '(?i)([A-Za-z]+ [0-9]{1,2}, [0-9]{4})', 1), '%B %d, %Y')::date as found from f)
    select filename, strftime(found, '%Y-%m-%d') as file_date, case when found is not null then (year(found) // 10 * 10) || 's' end as file_decade from d"""
)
def filename_dates(spark: SparkSession, folder: str) -> DataFrame:
    f = table(spark, folder, "parsed_crecb_speeches").where("filename is not null").select("filename").distinct()
    dated = f.withColumn("_date", T.filename_date("filename"))
    return dated.select("filename", F.date_format("_date", "yyyy-MM-dd").alias("file_date"), T.decade("_date").alias("file_decade"))


@query(
    r"""select distinct filename, regexp_matches(filename, '(?i)\b(January|February|March|April|May|June|July|August|September|October|November|December)\s+[0-9]{1,2},\s*[0-9]{4}\b')
        and not regexp_matches(filename, '(?i)\bHouse(?:\s+of\s+Representatives)?\b') and not regexp_matches(filename, '(?i)\bSenate\b') as is_general
    from parsed_crecb_speeches where filename is not null"""
)
def general_date_filter(spark: SparkSession, folder: str) -> DataFrame:
    f = table(spark, folder, "parsed_crecb_speeches").where("filename is not null").select("filename").distinct()
    return f.withColumn("is_general", T.is_general_with_date("filename"))


@query(
    r"""select distinct filename, translate(filename, '\/*?:"<>|', '') as sanitized, regexp_replace(regexp_replace(filename, '^[^-]*-', ''), '\.html$', '') as granule,
        try_cast(nullif(regexp_extract(folder || '/' || filename, '\b(18[0-9]{2}|19[0-9]{2}|2000)\b', 1), '') as integer) as path_year
    from parsed_crecb_speeches where filename is not null and folder is not null"""
)
def filename_sanitize(spark: SparkSession, folder: str) -> DataFrame:
    f = table(spark, folder, "parsed_crecb_speeches").where("filename is not null and folder is not null").select("filename", "folder").distinct()
    year = T.year_in_path(F.concat_ws("/", "folder", "filename"))
    return f.select(
        "filename", T.sanitize_filename("filename").alias("sanitized"), T.granule_of_filename("filename").alias("granule"), year.alias("path_year")
    ).distinct()


@query(
    r"""with p as (select distinct package_id from granule_summary where package_id <> ''),
    k as (select package_id, try_cast(nullif(regexp_extract(package_id, '([0-9]{4})', 1), '') as integer) as package_year,
        coalesce(try_cast(nullif(regexp_extract(package_id, '-pt([0-9]+)', 1), '') as integer), 0) as package_part from p)
    select *, row_number() over (order by package_year nulls first, package_part, package_id) as place from k"""
)
def package_order(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "granule_summary").where("package_id <> ''").select("package_id").distinct()
    keyed = p.withColumn("package_year", F.expr("try_cast(nullif(regexp_extract(package_id, '([0-9]{4})', 1), '') as int)"))
    keyed = keyed.withColumn("package_part", T.package_part("package_id"))
    # the place among all packages of the year and of the years before: years are few
    by_year = keyed.groupBy("package_year").count()
    before = by_year.withColumn(
        "before", F.coalesce(F.sum("count").over(W.orderBy(F.col("package_year").asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ).drop("count").withColumnRenamed("package_year", "_year")
    inside = F.row_number().over(W.partitionBy("package_year").orderBy("package_part", "package_id"))
    placed = keyed.withColumn("_in", inside).join(before, F.col("package_year").eqNullSafe(F.col("_year")))
    return placed.select("package_id", "package_year", "package_part", (F.col("_in") + F.col("before")).cast("bigint").alias("place"))


@query(
    """select granule_id, issue_day, case when mods_xml <> '' then count(*) filter (mods_xml <> '') over (partition by issue_day order by granule_id, xml_id rows between unbounded preceding and current row)
        || '-' || granule_id || '.xml' end as mods_file, xml_id from raw_xml where issue_day is not null and granule_id is not null"""
)
def granule_numbering(spark: SparkSession, folder: str) -> DataFrame:
    x = table(spark, folder, "raw_xml").where("issue_day is not null and granule_id is not null").select("xml_id", "granule_id", "issue_day", "mods_xml")
    # records fetched twice are told apart by their id
    numbered = files.number_granules(x, "issue_day", ["granule_id", "xml_id"], {"mods_xml": "xml"})
    return numbered.select("granule_id", "issue_day", F.col("mods_xml_file").alias("mods_file"), "xml_id")


@query(
    r"""with s as (select distinct granule_id, package_id, title, split_part(split_part(dateissued, 'T', 1), '-', 1) as issue_year
        from granule_summary where dateissued <> '' and granule_id <> '' and package_id <> '')
    select *, row_number() over (partition by issue_year order by package_id, granule_id, title nulls first) || '-' || translate(coalesce(title, ''), '\/*?:"<>|', '') || '-' || package_id || '_' || granule_id as file_name from s"""
)
def year_numbering(spark: SparkSession, folder: str) -> DataFrame:
    s = table(spark, folder, "granule_summary").where("dateissued <> '' and granule_id <> '' and package_id <> ''")
    s = s.select("granule_id", "package_id", "title", T.issue_year("dateissued").alias("issue_year")).distinct()
    return files.number_in_year(s, "issue_year", ["package_id", "granule_id", F.col("title").asc_nulls_first()], "package_id", "granule_id", "title")


@query("select distinct package_id, granule_id from granule_summary g where granule_id <> '' and package_id <> '' and not exists (select 1 from raw_xml x where x.granule_id = g.granule_id and x.mods_xml <> '')")
def resume_anti_join(spark: SparkSession, folder: str) -> DataFrame:
    """Granules known from summaries whose record wasn't fetched yet."""
    jobs = table(spark, folder, "granule_summary").where("granule_id <> '' and package_id <> ''").select("package_id", "granule_id").distinct()
    return files.not_done(jobs, table(spark, folder, "raw_xml").where("mods_xml <> ''"), ["granule_id"]).select("package_id", "granule_id")


@query(
    """with b as (select max(issue_day) as last from raw_xml)
    select cast(unnest(generate_series(last - interval 2 year, last::timestamp, interval 1 day)) as date) as day from b"""
)
def day_range(spark: SparkSession, folder: str) -> DataFrame:
    """The days of the two years before the newest issue, newest first."""
    last = table(spark, folder, "raw_xml").agg(F.max("issue_day").alias("last"))
    return last.select(F.explode(F.sequence(F.add_months("last", -24), "last")).alias("day")).orderBy(F.desc("day"))


@query("select distinct granule_id, case when granule_id like '%PgH%' then 'House' when granule_id like '%PgS%' then 'Senate' else '' end as section from granule_summary where granule_id like '%PgH%' or granule_id like '%PgS%'")
def chamber_filter(spark: SparkSession, folder: str) -> DataFrame:
    g = table(spark, folder, "granule_summary").where(F.col("granule_id").contains("PgH") | F.col("granule_id").contains("PgS"))
    return g.select("granule_id", T.section_of_granule("granule_id").alias("section")).distinct()


@query(
    """select x.xml_id, s.granule_id, s.package_id from (select distinct granule_id, package_id, dateissued from granule_summary where granule_id is not null) s
    join raw_xml x on x.granule_id = s.granule_id
    where regexp_matches(substring(s.dateissued, 1, 10), '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') and try_cast(substring(s.dateissued, 1, 10) as date) = x.issue_day"""
)
def same_day_filter(spark: SparkSession, folder: str) -> DataFrame:
    s = table(spark, folder, "granule_summary").where("granule_id is not null").select("granule_id", "package_id", "dateissued").distinct()
    joined = s.join(table(spark, folder, "raw_xml").select("xml_id", "granule_id", "issue_day"), "granule_id")
    return govinfo.same_day(joined, "issue_day").select("xml_id", "granule_id", "package_id")


@query(
    """select granule_id, (max_by({'t': title}, {'a': loaded_at, 'b': title})).t as title from
    (select granule_id, title, loaded_at from granule_summary) group by granule_id having count(*) > 0"""
)
def granule_titles(spark: SparkSession, folder: str) -> DataFrame:
    """The title of the summary loaded last, of each granule."""
    return pipelines.titles_of_granules(table(spark, folder, "granule_summary"))


@query(
    """with m as (select parsed_name, arg_max({'b': bioguideid, 'f': full_name, 'p': party, 's': state, 'c': speaker_chamber},
            {'b': bioguideid, 'f': full_name, 'p': party, 'c': speaker_chamber}) as r
        from (select parsed_name, coalesce(bioguideid, '') as bioguideid, coalesce(full_name, '') as full_name, coalesce(party, '') as party, coalesce(state, '') as state, coalesce(speaker_chamber, '') as speaker_chamber
            from mods_members where parsed_name is not null) group by parsed_name),
    t as (select granule_id, (max_by({'t': title}, {'a': loaded_at, 'b': title})).t as title from granule_summary group by granule_id)
    select coalesce(p.speech_date, '') as date, coalesce(x.granule_id, '') as granule_id, coalesce(t.title, '') as title, coalesce(p.speaker, '') as speaker, coalesce(p.speech, '') as text,
        coalesce(r.b, '') as "bioGuideId", coalesce(r.f, '') as full_name, coalesce(r.p, '') as party, coalesce(r.s, '') as state,
        case when p.speaker like 'Ms.%' or p.speaker like 'Mrs.%' then 'F' when p.speaker like 'Mr.%' then 'M' else '' end as gender,
        case when x.granule_id like '%PgH%' then 'H' when x.granule_id like '%PgS%' then 'S' else '' end as chamber, coalesce(r.c, '') as speaker_chamber
    from parsed_crecb_speeches p left join raw_xml x on x.xml_id = p.speech_id left join m on m.parsed_name = p.speaker left join t on t.granule_id = x.granule_id"""
)
def enriched_speeches(spark: SparkSession, folder: str) -> DataFrame:
    """The twelve columns of the daily edition for the bound speeches, each with the granule whose record bears its number."""
    s = table(spark, folder, "parsed_crecb_speeches").select("speech_id", F.col("speech_date").alias("date"), "speaker", F.col("speech").alias("text"))
    x = table(spark, folder, "raw_xml").select(F.col("xml_id").alias("speech_id"), "granule_id")
    columns = ["bioguideid", "full_name", "party", "state", "speaker_chamber"]
    members = table(spark, folder, "mods_members").where("parsed_name is not null").select("parsed_name", *[F.coalesce(c, F.lit("")).alias(c) for c in columns])
    members = asof.last_per_key(members, "parsed_name", ["bioguideid", "full_name", "party", "speaker_chamber"])
    return pipelines.enrich(s.join(x, "speech_id", "left"), members, granule_titles(spark, folder))


@query(
    r"""select distinct filename, folder, case when filename is null then 'no file name' else 'no date in the file name' end as reason from parsed_crecb_speeches
    where filename is null or try_strptime(regexp_extract(filename, '(?i)([A-Za-z]+ [0-9]{1,2}, [0-9]{4})', 1), '%B %d, %Y') is null"""
)
def undated_files(spark: SparkSession, folder: str) -> DataFrame:
    """The quarantine of the bound pipeline."""
    return pipelines.dated_texts(table(spark, folder, "parsed_crecb_speeches").select("filename", "folder").distinct())[1]


@query(
    r"""with p as (select speech_id, case when speech = '' then [] else string_split(regexp_replace(regexp_replace(speech, '\r\n|[\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]', chr(10), 'g'), '\n$', ''), chr(10)) end as parts
        from parsed_crecb_speeches where speech is not null)
    select speech_id, cast(i - 1 as integer) as line_no, parts[i] as line from p, unnest(range(1, len(parts) + 1)) as u(i)"""
)
def text_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of a text as reading it in Python gives them."""
    return _speech_texts(spark, folder).select("speech_id", F.posexplode(T.splitlines("speech")).alias("line_no", "line"))


@query(
    r"""select distinct folder || '/' || filename as rel_path, regexp_replace(folder || '/' || filename, '[/\\]+', '__', 'g') || '.removed.tsv' as log_name,
        folder || '/' || regexp_replace(filename, '\.[^.]*$', '') || '.txt' as text_name
    from parsed_crecb_speeches where filename is not null and folder is not null"""
)
def file_names(spark: SparkSession, folder: str) -> DataFrame:
    """Names under which clean texts, logs of removed lines and texts of scans are written."""
    f = table(spark, folder, "parsed_crecb_speeches").where("filename is not null and folder is not null").select("folder", "filename").distinct()
    path = F.concat_ws("/", F.lit("file:/data/in"), "folder", F.replace(F.replace("filename", F.lit("%"), F.lit("%25")), F.lit("+"), F.lit("%2B")))
    rel = files.relative_path(path, "/data/in")
    return f.select(rel.alias("rel_path"), files.log_name(rel).alias("log_name"), files.text_name(path, F.col("folder")).alias("text_name"))


@query(
    """with c as (select distinct granule_id, 'record' as found from raw_xml where mods_xml <> '' and granule_id is not null),
    p as (select distinct granule_id, 'summary' as found from granule_summary where granule_id is not null)
    select * from c union all select * from p where granule_id not in (select granule_id from c)"""
)
def merged_runs(spark: SparkSession, folder: str) -> DataFrame:
    """What a run has, and of an earlier one what it lacks."""
    now = table(spark, folder, "raw_xml").where("mods_xml <> '' and granule_id is not null").select("granule_id", F.lit("record").alias("found")).distinct()
    before = table(spark, folder, "granule_summary").where("granule_id is not null").select("granule_id", F.lit("summary").alias("found")).distinct()
    return files.merge_previous(now, before, ["granule_id"])


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as the day pages they were printed from."""
    d = table(spark, folder, "documents").where("text <> '' and issue_date is not null")
    granule = F.coalesce(F.nullif("granule_id", F.lit("")), F.col("doc_id").cast("string"))
    escaped = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", "&", "&amp;"), "<", "&lt;"), ">", "&gt;")
    html = F.concat(F.lit("<html><head><title>page</title></head><body><pre>\n"), escaped, F.lit("\n</pre></body></html>"))
    return d.select(F.col("issue_date").alias("day"), F.concat(F.col("doc_id").cast("string"), F.lit("-"), granule, F.lit(".html")).alias("filename"), html.alias("html"))


@query("select 1 + doc_id - 1 as doc_id, chr(10) || text || chr(10) as block from documents where text <> '' and issue_date is not null")
def pre_blocks(spark: SparkSession, folder: str) -> DataFrame:
    p = _pages(spark, folder)
    return p.select(F.split_part("filename", F.lit("-"), F.lit(1)).cast("bigint").alias("doc_id"), F.explode(metadata.pre_blocks_of("html")).alias("block"))


@query()
def mods_speaking_members(spark: SparkSession, folder: str) -> DataFrame:
    return metadata.speaking_members(table(spark, folder, "raw_xml"), ["xml_id"], "mods_xml")


@query()
def mods_titles(spark: SparkSession, folder: str) -> DataFrame:
    return metadata.record_titles(table(spark, folder, "raw_xml"), ["xml_id"], "mods_xml")


@query()
def members_last_wins(spark: SparkSession, folder: str) -> DataFrame:
    records = table(spark, folder, "raw_xml").withColumn("issue_day", F.coalesce("issue_day", F.to_date(F.lit("0001-01-01"))))
    return pipelines.members_of_records(records.withColumn("file_index", F.coalesce("file_index", F.lit(-1))), ["issue_day", "file_index", "xml_id"])


@query("select coalesce(sum(strlen(text)), 0)::bigint as bytes_in, coalesce(sum(strlen(regexp_replace(text, '[-_]{3,}', '', 'g'))), 0)::bigint as bytes_out, coalesce(sum(strlen(regexp_replace(text, '[-_]{3,}', '', 'g'))), 0) * 100.0::double / coalesce(sum(strlen(text)), 0) as kept_percent from documents where text is not null")
def byte_stats(spark: SparkSession, folder: str) -> DataFrame:
    d = _documents(spark, folder)
    return preclean.byte_totals(d, "text", d.select(F.regexp_replace("text", "[-_]{3,}", "").alias("text")), "text")


@query(
    """with p as (select doc_id, text, list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ')) as parts from documents where text is not null),
    recursive_parts as (
        with recursive r as (
            select doc_id, 1 as i, 0::bigint as at from p
            union all
            select r.doc_id, r.i + 1, (case when p.parts[r.i] = '' then r.at when instr(substring(p.text, r.at + 1), p.parts[r.i]) > 0 then r.at + instr(substring(p.text, r.at + 1), p.parts[r.i]) - 1 else r.at end) + length(p.parts[r.i])
            from r join p using (doc_id) where r.i <= len(p.parts))
        select * from r)
    select r.doc_id, cast(r.i - 1 as integer) as part_no, p.parts[r.i] as part,
        cast(case when p.parts[r.i] = '' then r.at when instr(substring(p.text, r.at + 1), p.parts[r.i]) > 0 then r.at + instr(substring(p.text, r.at + 1), p.parts[r.i]) - 1 else r.at end as integer) as "offset"
    from recursive_parts r join p using (doc_id) where r.i <= len(p.parts)"""
)
def cursor_offsets(spark: SparkSession, folder: str) -> DataFrame:
    d = _documents(spark, folder).withColumn("_parts", F.transform(F.split("text", "\n"), lambda x: F.trim(x)))
    return asof.cursor_offsets(d, "doc_id", "text", "_parts")


@query()
def crec_speeches(spark: SparkSession, folder: str) -> DataFrame:
    """The daily edition end to end: pages, records and summaries to the twelve-column table."""
    return pipelines.daily(_pages(spark, folder), members_last_wins(spark, folder), pipelines.titles_of_granules(table(spark, folder, "granule_summary")), "exact")


@query()
def crec_speeches_compat(spark: SparkSession, folder: str) -> DataFrame:
    return pipelines.daily(_pages(spark, folder), members_last_wins(spark, folder), pipelines.titles_of_granules(table(spark, folder, "granule_summary")))


@query()
def crecb_debates(spark: SparkSession, folder: str) -> DataFrame:
    """The bound edition end to end: each file's speeches with their labels as one scanned text."""
    s = table(spark, folder, "parsed_crecb_speeches").where("filename is not null and speech is not null")
    labelled = F.concat(F.lit("  "), F.coalesce("speaker", F.lit("")), F.lit(". "), "speech", F.lit("\n\n"))
    rows = s.groupBy("folder", "filename").agg(F.array_sort(F.collect_list(F.struct("speech_no", "speech_id", labelled.alias("t")))).alias("_t"))
    return pipelines.bound(rows.select("folder", "filename", F.array_join(F.transform("_t", lambda x: x["t"]), "").alias("text")))
