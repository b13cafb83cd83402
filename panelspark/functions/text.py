"""Text columns: tokens, headers, numbers, dates, labels."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F



def _foldings() -> tuple[str, str]:
    """Letters of the Latin blocks that decompose to one ASCII character, and what each folds to.

    A letter without a decomposition, such as the stroke l, is not among them: folding drops it.
    """
    pairs = [(chr(c), unicodedata.normalize("NFKD", chr(c)).encode("ascii", "ignore").decode())
             for block in (range(0xA0, 0x250), range(0x1E00, 0x1F00), range(0xFF01, 0xFF5F)) for c in block]
    one = [(a, b) for a, b in pairs if len(b) == 1]
    return "".join(a for a, _ in one), "".join(b for _, b in one)


ACCENTED, FOLDED = _foldings()
# Valid years and the end of quarter by roman numeral.
FIRST_YEAR, LAST_YEAR = "1678", "2261"
QUARTER_END = {"I": "03-31", "II": "06-30", "III": "09-30", "IV": "12-31"}


def tokens(text: Column | str) -> Column:
    """Runs of letters and digits."""
    return F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def normalise_header(col: Column | str) -> Column:
    """ASCII-folded lower-case header without units, spaces and punctuation."""
    c = F.translate(col, ACCENTED, FOLDED)
    c = F.regexp_replace(c, r"[^\x00-\x7F]", "")
    c = F.regexp_replace(c, r"\(tys.\.\)\*?", "")
    return F.lower(F.translate(c, "* .()", ""))


def parse_number(col: Column | str) -> Column:
    """Number text with a decimal comma and (no-break) spaces; bad text gives NULL."""
    c = F.translate(col, ",\u00a0 ", ".")
    return F.when(c != "", c.try_cast("double"))


def coerce_number(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast("double")


def parse_date(col: Column | str) -> Column:
    """Date of a text or timestamp column; bad text gives NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("string").try_cast("timestamp").cast("date")


def quarter_date(label: Column | str) -> Column:
    """End of the quarter named by a roman numeral and a year; invalid labels give NULL.

    Years outside the range of nanosecond timestamps count as invalid.
    """
    label = F.col(label) if isinstance(label, str) else label
    roman = F.regexp_extract(label, "([IV]+)", 1)
    year = F.regexp_extract(label, r"(\d{4})", 1)
    ends = F.create_map(*[F.lit(x) for kv in QUARTER_END.items() for x in kv])
    ok = F.replace(label, F.lit(" "), F.lit("")) != "Q0000"
    text = F.concat_ws("-", F.when(ok & year.between(FIRST_YEAR, LAST_YEAR), year), ends[roman])
    return F.when(F.length(text) == 10, text).try_cast("date")


def quarter_month(year: Column, quarter: Column) -> Column:
    """First day of the last month of a quarter."""
    return F.make_date(year, quarter * 3, F.lit(1))


def news_text(headline: Column | str, content: Column | str, chars: int | None = None) -> Column:
    """Lower-case headline and content; ``chars`` cuts the content, None takes it whole."""
    body = F.substring(content, 1, chars) if chars else content
    return F.lower(F.concat_ws(" ", headline, body))


def join_paragraphs(paragraphs: Column, whole: Column) -> Column:
    """Non-empty paragraphs joined by newlines, or the whole text when there are none."""
    kept = F.filter(F.transform(paragraphs, lambda p: F.trim(p)), lambda p: p != "")
    return F.when(F.size(paragraphs) > 0, F.array_join(kept, "\n")).otherwise(F.trim(whole))


def strip_tags(html: Column) -> Column:
    return F.regexp_replace(html, "<[^>]*>", "")


def feature_names(payload: Column | str) -> Column:
    """Feature names of a JSON payload.

    A list of names is taken as it is; a list of records gives the first of the
    usual name keys; a map of name to number gives the names by falling value;
    no payload gives no names.
    """
    names = F.from_json(payload, "array<string>", {"mode": "PERMISSIVE"})
    records = F.from_json(payload, "array<struct<feature:string,name:string,col:string,column:string>>")
    ranks = F.from_json(payload, "map<string,double>")
    ordered = F.array_sort(F.map_entries(ranks), lambda a, b: F.when(
        a["value"] > b["value"], -1).when(a["value"] < b["value"], 1)
        .when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
    text = F.trim(payload)
    rec = F.transform(records, lambda r: F.coalesce(r["feature"], r["name"], r["col"], r["column"]))
    return (F.when(text.startswith("{"), F.transform(ordered, lambda e: e["key"]))
            .when(text.rlike(r"^\[\s*\{"), F.array_compact(rec))
            .otherwise(F.coalesce(names, F.array().cast("array<string>"))))
