"""Text column functions (X1-X29 helpers) built only from Spark built-ins.

Each function takes and returns a ``Column`` so it fuses into whole-stage
codegen; none of them is a Python UDF.
"""
from __future__ import annotations

import re
import unicodedata
from functools import reduce
from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

from quadra import dims

# Java's \s does not match U+00A0 (NBSP); listing pages use it in money text.
WS = "[\\s\\x{00A0}]"
_BLANKS = " \t\n\x0b\f\r\xa0"

_ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüçñÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑ"
_PLAIN = "aaaaaeeeeiiiiooooouuuucnAAAAAEEEEIIIIOOOOOUUUUCN"


def _class(codes) -> str:
    """A regex class of single characters: tested by one look into a table, unlike ranges."""
    return "".join(f"\\x{i:02X}" for i in codes)


#: Latin-1 letters with one plain upper case, and characters that are none of its letters.
_LATIN = [i for i in range(0xFF) if chr(i).isalpha() and i not in (0xAA, 0xB5, 0xBA, 0xDF)]
_NO_LETTER = [i for i in range(0xFF) if not chr(i).isalpha()]
#: Other characters; a letter behind a non-letter that is no blank.
_OTHER, _INNER = f"[^{_class(_LATIN + _NO_LETTER)}]", f"[^{_class([0x20, *_LATIN])}][{_class(_LATIN)}]"

def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_accents_py(s: str) -> str:
    """Driver-side helper for building small dimensions only."""
    return "".join(ch for ch in unicodedata.normalize("NFD", s) if unicodedata.category(ch) != "Mn")


def strip_accents(c) -> Column:
    """Drop Portuguese diacritics (pt-BR alphabet)."""
    return F.translate(_c(c), _ACCENTED, _PLAIN)


def trim_ws(c) -> Column:
    """Trim blanks including NBSP (Python ``str.strip`` semantics for our inputs)."""
    c = _c(c)
    # before one of these at the end, a regex's ``$`` matches too
    ends = reduce(Column.__or__, [c.endswith(x) for x in "\x85\u2028\u2029"])
    return F.when(ends, F.regexp_replace(c, f"^{WS}+|{WS}+$", "")).otherwise(F.btrim(c, F.lit(_BLANKS)))


def normalize_ws(c) -> Column:
    """Runs of blanks -> one blank, trimmed."""
    return trim_ws(F.regexp_replace(_c(c), f"{WS}+", " "))


def title_case(c) -> Column:
    """Python ``str.title``: upper-case a letter that follows a non-letter, lower the rest.

    ``initcap`` only splits on blanks, so ``freguesia (ilha)`` would stay
    ``Freguesia (ilha)``; here the text is cut into letter / non-letter runs.
    """
    # letters go with the non-letters behind them where a blank or comma, which has no case, comes first: half the runs
    c = _c(c)
    runs = F.regexp_extract_all(c, F.lit("(\\p{L}+(?:[ ,][^\\p{L}]*)?|[^\\p{L}]+)"), F.lit(1))
    cased = F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 1 << 30))))
    # in plain Latin whose words begin at blanks, initcap does the same at a fraction of the cost
    return F.when(c.rlike(_OTHER) | c.rlike(_INNER), F.array_join(cased, "")).otherwise(F.initcap(c))


def std_text(c) -> Column:
    """Trim + title case; NULL text becomes the literal ``Nan`` like the source."""
    return title_case(clean_text(c))


def clean_text(c) -> Column:
    """The trimmed text of :func:`std_text`, before its title case."""
    return trim_ws(F.coalesce(_c(c).cast("string"), F.lit("nan")))


def _alternatives(pattern: str) -> list[str]:
    """The pattern cut at the ``|`` outside of groups and classes."""
    out, depth, last = [""], 0, ""
    for ch in pattern:
        depth += (ch in "([") - (ch in ")]") if last != "\\" else 0
        if ch == "|" and depth == 0 and last != "\\":
            out.append("")
        else:
            out[-1] += ch
        last = "" if last == "\\" else ch
    return out


def _literals(alternative: str) -> list[str] | None:
    """The texts that an alternative of plain characters and classes like ``[eé]`` stands for; None for any other."""
    parts = re.split(r"(\[[^\]^\-\\&\[]+\])", alternative)
    if not alternative or any(re.search(r"[.\\?*+(){}^$\[\]]", x) for x in parts[::2]):
        return None
    return ["".join(x) for x in product(*[x[1:-1] if i % 2 else [x] for i, x in enumerate(parts)])]


def _needed(alternative: str) -> str | None:
    """A text of two or more characters that every match of the alternative contains; None if none is plain to see."""
    if re.search(r"\(\?(?!:)|\\[^bBdDsSwW\W]|\\$|&&|\[[^\]]*\[", alternative):
        return None  # flags, lookaround, escapes with arguments, nested classes
    flat, last = re.sub(r"\\.|\[\^?\]?[^\]]*\]", "\0", alternative), ""
    while flat != last:
        last, flat = flat, re.sub(r"\([^()]*\)", "\0", flat)
    if re.search(r"[()\[\]|]", flat):
        return None
    flat = re.sub(r"\{[^}]*\}", "{", flat)
    runs = re.split(r"[\0.^$+?*{}]+", re.sub(r".[?*{]", "\0", flat))
    longest = max(runs, key=len)
    return longest if len(longest) >= 2 else None


def found(text: Column, pattern: str) -> Column:
    """``text.rlike(pattern)``: alternatives that are plain text are looked for as bytes, the others as regexes, each only in
    texts that hold the plain text it cannot match without."""
    plain, rest, tests = [], [], []
    for alternative in _alternatives(pattern):
        literals, needed = _literals(alternative), _needed(alternative)
        if literals is not None:
            plain += literals
        elif needed:
            tests.append(text.contains(needed) & text.rlike(alternative))
        else:
            rest.append(alternative)
    plain = [x for x in dict.fromkeys(plain) if not any(y != x and y in x for y in plain)]
    return reduce(Column.__or__, [text.contains(x) for x in plain] + tests + ([text.rlike("|".join(rest))] if rest else []))


def extract_number(c, default: int | None = 0) -> Column:
    """Concatenate every digit of the text and parse it (``'2-3'`` -> 23)."""
    digits = F.regexp_replace(_c(c), "[^0-9]", "")
    parsed = F.when(F.length(digits) > 0, digits.try_cast("bigint"))
    return parsed if default is None else F.coalesce(parsed, F.lit(default).cast("bigint"))


def _br_number(s: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(s, "\\.", ""), ",", ".").try_cast("double")


def extract_decimal(c, default: float | None = 0.0) -> Column:
    """Brazilian money text -> double.

    First ``R$ <digits.,>``; else the first Brazilian-formatted number if it is > 0.
    """
    col = _c(c)
    with_prefix = F.regexp_extract(col, f"R\\${WS}*([0-9.,]+)", 1)
    first = F.when(with_prefix != "", _br_number(with_prefix))
    plain = F.regexp_extract(col, "([0-9]+(?:\\.[0-9]{3})*(?:,[0-9]{1,2})?)", 1)
    fallback = F.when(plain != "", _br_number(plain))
    fallback = F.when(fallback > 0, fallback)
    out = F.coalesce(first, fallback)
    return out if default is None else F.coalesce(out, F.lit(float(default)))


def month_map() -> Column:
    return F.create_map(*[x for name, num in dims.MONTHS_PT for x in (F.lit(name), F.lit(num))])


def parse_pt_date(c) -> Column:
    """``'12 de março de 2025'`` -> ``'2025-03-12'``; unmatched text is returned unchanged."""
    col = _c(c)
    pat = "(?i)([0-9]{1,2})\\s+de\\s+([A-Za-zç]+)\\s+de\\s+([0-9]{4})"
    day = F.regexp_extract(col, pat, 1)
    month = F.element_at(month_map(), F.lower(F.regexp_extract(col, pat, 2)))
    year = F.regexp_extract(col, pat, 3)
    iso = F.format_string("%04d-%02d-%02d", year.cast("int"), month, day.cast("int"))
    return F.when((day != "") & month.isNotNull(), iso).otherwise(col)


def parse_relative_days(c, kind: str) -> Column:
    """``'publicado há 3 semanas'`` -> 21 days; hours/minutes -> 0; no match -> 0."""
    pat = (kind + "\\s+h[aá]\\s+([0-9]+)\\s+(dia|dias|semana|semanas|m[eê]s|meses|ano|anos|"
           "hora|horas|minuto|minutos)")
    low = F.lower(_c(c))
    n = F.regexp_extract(low, pat, 1)
    unit = F.regexp_extract(low, pat, 2)
    nval = n.try_cast("int")
    mult = (F.when(unit.contains("hora") | unit.contains("minuto"), 0)
            .when(unit.contains("dia"), 1)
            .when(unit.contains("semana"), 7)
            .when(unit.rlike("m[eê]s|meses"), 30)
            .when(unit.contains("ano"), 365)
            .otherwise(0))
    return F.coalesce(F.when(n != "", nval * mult), F.lit(0))


def canonical_id(url) -> Column:
    """``id-(\\d+)`` of the url, else the url itself."""
    u = _c(url).cast("string")
    found = F.nullif(F.regexp_extract(u, "id-([0-9]+)", 1), F.lit(""))
    return F.coalesce(found, u, F.lit("nan"))


def split_coordinates(c) -> tuple[Column, Column]:
    """X11: ``'lat,lon'`` -> two doubles; unparsable parts -> 0.0 (unknown point)."""
    parts = F.split(_c(c).cast("string"), ",")
    lat = F.coalesce(F.get(parts, 0).try_cast("double"), F.lit(0.0))
    lon = F.coalesce(F.get(parts, 1).try_cast("double"), F.lit(0.0))
    return lat, lon


def bool_to_int(c) -> Column:
    """``True/False`` text, booleans or numbers -> 0/1 int (anything else 0)."""
    s = _c(c).cast("string")
    mapped = (F.when(s.isin("True", "true"), F.lit(1.0))
              .when(s.isin("False", "false"), F.lit(0.0))
              .otherwise(s.try_cast("double")))
    return F.coalesce(mapped.try_cast("int"), F.lit(0))


def to_double0(c) -> Column:
    """Text or numbers as double; what is no finite number (unparsable, NaN, infinite, NULL) is 0."""
    x = _c(c).cast("string").try_cast("double")
    return F.when(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")), x).otherwise(F.lit(0.0))


def to_int0(c, kind: str = "int") -> Column:
    """As :func:`to_double0`, then truncated; beyond the type's range 0."""
    return F.coalesce(to_double0(c).try_cast(kind), F.lit(0).cast(kind))
