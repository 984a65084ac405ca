"""Ingest transforms (P01–P35), re-aimed from per-document processors to whole-table columns.

Each function is ``DataFrame -> DataFrame`` and adds or rewrites columns with built-in
expressions only, so a chain of them is one projection inside whole-stage codegen.
``Pipeline`` chains steps (V03); ``df.transform(fn)`` hooks a user step in (V02).
"""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, NumericType, StringType

from searchlake.operators.util import bounded_broadcast, fold


class Pipeline:
    """Ordered chain of ``DataFrame -> DataFrame`` steps."""

    def __init__(self, steps: Sequence[Callable[[DataFrame], DataFrame]]):
        self.steps = list(steps)

    def __call__(self, df: DataFrame) -> DataFrame:
        for s in self.steps:
            df = df.transform(s)
        return df


# ------------------------------------------------------------------ field selection

def select_fields(df: DataFrame, names: Sequence[str] = (), regex: str | None = None,
                  types: Sequence[type] = (), exclude: Sequence[str] = ()) -> list[str]:
    """Columns chosen by name, regex, type class, minus exclusions (name or glob)."""
    out = []
    for f in df.schema.fields:
        hit = f.name in names or (regex is not None and re.fullmatch(regex, f.name)) or \
            any(isinstance(f.dataType, t) for t in types)
        if hit and not any(fnmatch.fnmatchcase(f.name, e) for e in exclude):
            out.append(f.name)
    return out


def ignore_fields(df: DataFrame, pattern: str) -> DataFrame:
    """Drop columns matching a glob."""
    return df.drop(*[c for c in df.columns if fnmatch.fnmatchcase(c, pattern)])


# ------------------------------------------------------------------ copy / clone / concat

def _as_array(df: DataFrame, c: str) -> Column:
    if isinstance(df.schema[c].dataType, ArrayType):
        return F.coalesce(F.col(c), F.array())
    return F.when(F.col(c).isNull(), F.array()).otherwise(F.array(F.col(c)))


def clone_field(df: DataFrame, srcs: Sequence[str], dest: str) -> DataFrame:
    """Append the values of ``srcs`` to the multi-valued ``dest``."""
    parts = ([_as_array(df, dest)] if dest in df.columns else []) + \
        [_as_array(df, s).cast("array<string>") for s in srcs]
    return df.withColumn(dest, F.concat(*[p.cast("array<string>") for p in parts]))


def copy_field(df: DataFrame, src: str, dest: str, max_chars: int | None = None) -> DataFrame:
    """copyField with an optional character cap on each copied value."""
    v = F.col(src).cast("string")
    if max_chars is not None:
        v = F.substring(v, 1, max_chars)
    return df.withColumn(dest, v)


def concat_values(df: DataFrame, col: str, delimiter: str = ", ") -> DataFrame:
    """Join a multi-valued field into one string."""
    return df.withColumn(col, F.array_join(F.col(col).cast("array<string>"), delimiter))


def count_values(df: DataFrame, col: str, dest: str | None = None) -> DataFrame:
    """Number of values (P05); missing → 0."""
    return df.withColumn(dest or col, F.coalesce(F.size(F.col(col)), F.lit(0)).cast("int") if
                         isinstance(df.schema[col].dataType, ArrayType) else
                         F.when(F.col(col).isNull(), 0).otherwise(1))


def field_length(df: DataFrame, col: str, dest: str | None = None) -> DataFrame:
    """Length in characters (P06); multi-values map element-wise."""
    if isinstance(df.schema[col].dataType, ArrayType):
        return df.withColumn(dest or col, F.transform(F.col(col), lambda x: F.length(x)))
    return df.withColumn(dest or col, F.length(F.col(col)))


def first_value(df: DataFrame, col: str) -> DataFrame:
    """P07."""
    return df.withColumn(col, F.try_element_at(F.col(col), F.lit(1)))


def last_value(df: DataFrame, col: str) -> DataFrame:
    """P08."""
    return df.withColumn(col, F.try_element_at(F.col(col), F.lit(-1)))


def min_value(df: DataFrame, col: str) -> DataFrame:
    """P09."""
    return df.withColumn(col, F.array_min(F.col(col)))


def max_value(df: DataFrame, col: str) -> DataFrame:
    """P10."""
    return df.withColumn(col, F.array_max(F.col(col)))


def uniq_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values, first-seen order."""
    return df.withColumn(col, F.array_distinct(F.col(col)))


# ------------------------------------------------------------------ string cleanup

# Fixed value: the whitespace class trimmed (Java's Character.isWhitespace plus no-break space).
_WS = r"[\s   ]"


def trim_fields(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P12."""
    for c in cols:
        df = df.withColumn(c, F.regexp_replace(F.col(c), f"^{_WS}+|{_WS}+$", ""))
    return df


def truncate_fields(df: DataFrame, cols: Sequence[str], n: int) -> DataFrame:
    """P13."""
    for c in cols:
        df = df.withColumn(c, F.substring(F.col(c), 1, n))
    return df


def remove_blank(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Empty strings become missing; empty elements leave multi-values."""
    for c in cols:
        if isinstance(df.schema[c].dataType, ArrayType):
            df = df.withColumn(c, F.filter(F.col(c), lambda x: F.length(x) > 0))
        else:
            df = df.withColumn(c, F.nullif(F.col(c), F.lit("")))
    return df


def regex_replace(df: DataFrame, cols: Sequence[str], pattern: str, replacement: str) -> DataFrame:
    """P16."""
    for c in cols:
        df = df.withColumn(c, F.regexp_replace(F.col(c), pattern, replacement))
    return df


# Named HTML entities decoded by the strip step (the common set).
HTML_ENTITIES = {
    "&amp;": "&", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&#39;": "'", "&nbsp;": " ",
    "&copy;": "©", "&reg;": "®", "&eacute;": "é", "&egrave;": "è", "&agrave;": "à", "&uuml;": "ü",
    "&ouml;": "ö", "&auml;": "ä", "&szlig;": "ß", "&ccedil;": "ç", "&ntilde;": "ñ", "&hellip;": "…",
    "&mdash;": "—", "&ndash;": "–",
}


def html_strip_expr(c: Column) -> Column:
    """HTML → text (P17/T20): drop comments, script/style bodies and tags (block tags become a
    space), then decode entities. Regex subset shared with RE2 so the oracle can run it."""
    x = F.regexp_replace(c, r"(?s)<!--.*?-->", " ")
    x = F.regexp_replace(x, r"(?is)<script[^>]*>.*?</script>", " ")
    x = F.regexp_replace(x, r"(?is)<style[^>]*>.*?</style>", " ")
    x = F.regexp_replace(x, r"<[^>]*>", " ")
    for k, v in HTML_ENTITIES.items():
        if k != "&amp;":
            x = F.replace(x, F.lit(k), F.lit(v))
    return F.replace(x, F.lit("&amp;"), F.lit("&"))


def decode_entities(text: Column) -> Column:
    """HTML character references decoded once each: all named ones of HTML 4 (from the standard library's table), decimal and
    hexadecimal numbers; an unknown or impossible one stays."""
    from html.entities import name2codepoint

    named = F.create_map(*[F.lit(x) for k, v in sorted({**name2codepoint, "apos": 39}.items()) for x in (f"&{k};", chr(v))])
    number = lambda p: F.when(p.rlike("^&#[0-9]{1,7};$"), F.regexp_extract(p, "^&#([0-9]+);$", 1).cast("long")).when(
        p.rlike("^&#[xX][0-9A-Fa-f]{1,6};$"), F.conv(F.regexp_extract(p, "^&#[xX]([0-9A-Fa-f]+);$", 1), 16, 10).cast("long"))

    def letter(n: Column) -> Column:
        """A code point as text, by way of its four UTF-32 bytes."""
        fine = (n > 0) & (n < 0x110000) & ~n.between(0xD800, 0xDFFF)
        return F.when(fine, F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))

    def piece(p: Column) -> Column:
        return F.when(p.startswith("&"), F.coalesce(F.element_at(named, p), letter(number(p)), p)).otherwise(p)

    parts = F.regexp_extract_all(text, F.lit("(?s)&#?[A-Za-z0-9]+;|[^&]+|&"), F.lit(0))
    return F.when(text.contains("&"), F.array_join(F.transform(parts, piece), "")).otherwise(text)


def html_strip(df: DataFrame, col: str, dest: str | None = None) -> DataFrame:
    return df.withColumn(dest or col, html_strip_expr(F.col(col)))


# ------------------------------------------------------------------ defaults

def default_value(df: DataFrame, col: str, value) -> DataFrame:
    """P18."""
    if col not in df.columns:
        return df.withColumn(col, F.lit(value))
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(value).cast(df.schema[col].dataType)))


def timestamp_default(df: DataFrame, col: str, now=None) -> DataFrame:
    """Missing → NOW (fixed per job so every row gets the same instant)."""
    v = F.lit(now) if now is not None else F.current_timestamp()
    return df.withColumn(col, F.coalesce(F.col(col), v) if col in df.columns else v)


def uuid_default(df: DataFrame, col: str) -> DataFrame:
    """P20: missing → random UUID."""
    return df.withColumn(col, F.coalesce(F.col(col), F.expr("uuid()")) if col in df.columns else F.expr("uuid()"))


# ------------------------------------------------------------------ parsing and type guessing

# Default true/false spellings of the boolean parser.
TRUE_VALUES = ["true", "yes", "on"]
FALSE_VALUES = ["false", "no", "off"]


def parse_boolean(df: DataFrame, col: str, true_values=TRUE_VALUES, false_values=FALSE_VALUES,
                  case_sensitive: bool = False) -> DataFrame:
    """Values in the true/false lists become booleans. A value in neither is left unchanged: as the column is typed,
    it moves to ``<col>_unparsed`` (see ``_parsed``)."""
    v = F.trim(F.col(col))
    k = v if case_sensitive else F.lower(v)
    tv = list(true_values) if case_sensitive else [t.lower() for t in true_values]
    fv = list(false_values) if case_sensitive else [t.lower() for t in false_values]
    return _parsed(df, col, F.when(k.isin(tv), True).when(k.isin(fv), False))


def _parsed(df: DataFrame, col: str, value: Column) -> DataFrame:
    """Replace ``col`` by its parsed value and keep what did not parse, unchanged, in ``<col>_unparsed``."""
    return df.withColumns({col: value, f"{col}_unparsed": F.when(value.isNull(), F.col(col))})


def parse_number(df: DataFrame, col: str, kind: str = "double", grouping: str = ",") -> DataFrame:
    """Strip grouping separators, ``try_cast`` to the type; what does not parse is kept (``_parsed``)."""
    v = F.regexp_replace(F.trim(F.col(col)), re.escape(grouping), "") if grouping else F.trim(F.col(col))
    return _parsed(df, col, v.try_cast(kind))


def parse_date(df: DataFrame, col: str, formats: Sequence[str], tz: str = "UTC") -> DataFrame:
    """First format that parses wins; local times are read in ``tz``."""
    tries = [F.try_to_timestamp(F.col(col), F.lit(f)) for f in formats]
    parsed = F.coalesce(*tries)
    if tz != "UTC":
        parsed = F.to_utc_timestamp(parsed, tz)
    return _parsed(df, col, parsed)


def infer_types(df: DataFrame, cols: Sequence[str] | None = None,
                order: Sequence[str] = ("boolean", "long", "double", "timestamp")) -> DataFrame:
    """Schema growth by type guessing (P21): per string column, the first type in ``order`` that
    *every* non-null value parses as; one aggregate pass computes all verdicts, then casts."""
    cols = [c for c in (cols or df.columns) if isinstance(df.schema[c].dataType, StringType)]
    checks = []
    for c in cols:
        v = F.trim(F.col(c))
        for t in order:
            if t == "boolean":
                ok = F.lower(v).isin("true", "false")
            elif t == "timestamp":
                ok = F.try_to_timestamp(v).isNotNull()
            else:
                ok = v.try_cast(t).isNotNull()
            checks.append(F.bool_and(F.when(F.col(c).isNull(), True).otherwise(ok)).alias(f"{c}::{t}"))
    if not checks:
        return df
    verdict = df.agg(*checks).first().asDict()  # one row of booleans, scalars only
    for c in cols:
        for t in order:
            if verdict.get(f"{c}::{t}"):
                v = F.trim(F.col(c))
                df = df.withColumn(c, (F.lower(v) == "true") if t == "boolean" else
                                   (F.try_to_timestamp(v) if t == "timestamp" else v.try_cast(t)))
                break
    return df


# ------------------------------------------------------------------ URL classification

# Path endings of landing pages.
LANDING_PAGES = ["/", "index.html", "index.htm", "index.phtml", "index.shtml", "index.xml", "index.php", "index.asp",
                 "index.aspx", "welcome.html", "welcome.htm", "welcome.phtml", "welcome.shtml", "welcome.xml",
                 "welcome.php", "welcome.asp", "welcome.aspx"]


def url_classify(df: DataFrame, col: str, prefix: str = "url") -> DataFrame:
    """URL features (P32): length, levels (slashes of the lower-cased path without its landing ending), top-level
    flag (no such path), landing-page flag, domain, canonical URL (scheme://host/path without query, fragment
    or landing-page name). A URL with a query is neither top-level nor a landing page."""
    u = F.col(col)
    no_frag = F.regexp_replace(u, "#.*$", "")
    no_query = F.regexp_replace(no_frag, r"\?.*$", "")
    host = F.regexp_extract(u, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]+)", 1)
    path = F.regexp_extract(no_query, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+(/.*)?$", 1)
    ending = "(" + "|".join(re.escape(p) for p in LANDING_PAGES) + ")$"
    bare = F.regexp_replace(F.regexp_replace(F.lower(path), ending, ""), "/+$", "")
    levels = F.length(bare) - F.length(F.replace(bare, F.lit("/"), F.lit("")))
    no_query_part = ~F.coalesce(no_frag.contains("?"), F.lit(False))
    is_landing = F.coalesce(F.lower(path).rlike(ending), F.lit(False)) & no_query_part
    canon_path = F.when(is_landing, F.regexp_replace(path, "[^/]*$", "")).otherwise(path)
    scheme = F.regexp_extract(u, r"^([a-zA-Z][a-zA-Z0-9+.-]*)://", 1)
    return (df.withColumn(f"{prefix}_length", F.length(u))
            .withColumn(f"{prefix}_levels", levels)
            .withColumn(f"{prefix}_toplevel", (bare == "") & no_query_part)
            .withColumn(f"{prefix}_landingpage", is_landing)
            .withColumn(f"{prefix}_domain", F.lower(host))
            .withColumn(f"{prefix}_canonical", F.concat(F.lower(scheme), F.lit("://"), F.lower(host),
                                                        F.when(canon_path == "", "/").otherwise(canon_path))))


# ------------------------------------------------------------------ regex boost

def regex_boost(df: DataFrame, col: str, rules: list[tuple[str, float]], dest: str = "boost",
                base: float = 1.0) -> DataFrame:
    """Product of the boosts of *all* rules whose pattern matches the whole value.

    Rules are user-given and few; each becomes one ``when(rlike)`` factor in a single expression."""
    factors = [F.when(F.coalesce(F.col(col).rlike(f"^(?:{p})$"), F.lit(False)), F.lit(float(b)))
               .otherwise(F.lit(1.0)) for p, b in rules]
    return df.withColumn(dest, fold(lambda a, b: a * b, [F.lit(float(base))] + factors))


# ------------------------------------------------------------------ pre-analyzed tokens

PREANALYZED_SCHEMA = "struct<v:string,tokens:array<struct<t:string,s:int,e:int,i:int,p:string,y:string>>>"


def explode_preanalyzed(df: DataFrame, key: str, col: str) -> DataFrame:
    """JSON pre-analyzed field → token table ``doc_id, pos, term, start, end, payload, type``.

    ``i`` is the position increment (default 1); positions are the running sum of increments
    per document (a window partitioned by doc: one doc's tokens form one bounded group)."""
    from pyspark.sql import Window

    parsed = F.from_json(F.col(col), PREANALYZED_SCHEMA)
    out = df.select(F.col(key).alias("doc_id"), F.posexplode(parsed["tokens"]).alias("idx", "tok"))
    w = Window.partitionBy("doc_id").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    out = out.withColumn("pos", (F.sum(F.coalesce(F.col("tok.i"), F.lit(1))).over(w) - 1).cast("int"))
    return out.select("doc_id", "pos", F.col("tok.t").alias("term"), F.col("tok.s").alias("start"),
                      F.col("tok.e").alias("end"), F.col("tok.p").alias("payload"), F.col("tok.y").alias("type"))


# ------------------------------------------------------------------ validation

def validate_docs(df: DataFrame, key: str, required: Sequence[str], known: Sequence[str] | None = None) -> DataFrame:
    """One row per problem (P35): ``key, field, reason`` for missing required fields and, given
    ``known``, for populated fields outside the schema."""
    checks = [F.when(F.col(c).isNull(), F.struct(F.lit(c).alias("field"), F.lit("missing required field")
                                                   .alias("reason"))) for c in required]
    if known is not None:
        for c in df.columns:
            if c not in known and c != key:
                checks.append(F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("field"),
                                                                     F.lit("unknown field").alias("reason"))))
    probs = F.filter(F.array(*checks), lambda x: x.isNotNull())
    return df.select(F.col(key), F.explode(probs).alias("p")).select(key, "p.field", "p.reason")
