"""Secret scan with multipart credential linking.

Base kinds are reported wherever they match: assignments of a password-like
name to a value, access identifiers, and long hex strings. Weak candidates
(account identifiers, secret-looking values, endpoints) prove nothing alone.
They are joined, as intervals of one document, with the complementary parts
within ``SCOPE`` characters: an identifier is reported beside a secret, a secret
beside an identifier, an endpoint beside both. The interval join walks each
document's candidates in order, keeping the nearest part on either side, so it
makes no pairs.

Matches are found by built-in regular expression functions: their places follow
from the lengths of the matches and of the text between them. Everything is
DataFrame functions; only documents with a candidate are exploded, and only
into lengths, never texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCOPE = 200


def any_case(words: str) -> str:
    """A pattern of alternatives with every ASCII letter in either case."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


def _assigned(words: str, value: str) -> str:
    return f"(?:{any_case(words)})[\"']?\\x20*[:=]\\x20*[\"']?({value}+)"


VALUE = "[A-Za-z0-9+/_.=-]"
#: kind: (pattern, least length of group 1 or of the match, text that every match contains).
PATTERNS = {
    "assign": (_assigned("password|passwd|secret|token|api_?key", VALUE), 8, (":", "=")),
    "access": ("(AKIA[A-Z0-9]+)", 16, ("AKIA",)),
    "hex": ("([0-9a-f]{32,})", 32, ()),
    "identifier": (_assigned("access_?key_?id|client_?id|account_?id|user_?name|user|login", "[A-Za-z0-9+/_.@-]"), 3, (":", "=")),
    "named": (_assigned("secret_?access_?key|access_?key|private_?key|client_?key|pwd|pass|auth", VALUE), 8, (":", "=")),
    "bare": ("([A-Za-z0-9+/]{32,})", 32, ()),
    "endpoint": ("(https?://[A-Za-z0-9._:/?&=%~+-]+)", 10, ("://",)),
}
KINDS = list(PATTERNS)
BASE = ("assign", "access", "hex")
#: Names in results.
NAMES = {"identifier": "linked_id", "named": "linked_secret", "bare": "linked_secret", "endpoint": "linked_endpoint"}


def _quote(pattern: str) -> str:
    return pattern.replace("\\", "\\\\").replace("'", "\\'")


def _matches(kind: str) -> Column:
    pattern, _, needed = PATTERNS[kind]
    found = f"regexp_extract_all(text, '{_quote(pattern)}', 0)"
    if needed:
        test = " or ".join(f"contains(text, '{x}')" for x in needed)
        found = f"case when {test} then {found} else array() end"
    return F.expr(found)


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, th, kind, start, end) of all matches long enough; th is a hash of the text, places are in code points.

    ``kind`` is an index into ``KINDS``. Rows equal in doc_id and text are one.
    """
    text = F.col("text").cast("string")
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"),
                    F.coalesce(text, F.lit("")).alias("text"))
    d = d.select("*", *(_matches(k).alias(f"m_{k}") for k in KINDS))
    # The text between the matches, only where there are any.
    d = d.select("doc_id", "th", *(f"m_{k}" for k in KINDS), *(
        F.expr(f"case when size(m_{k}) > 0 then split(text, '{_quote(PATTERNS[k][0])}', -1) end").alias(f"s_{k}") for k in KINDS))
    each = []
    for n, k in enumerate(KINDS):
        value = f"length(regexp_extract(x, '{_quote(PATTERNS[k][0])}', 1))"
        if k == "bare":  # lower and upper case and digits
            value = f"if(x rlike '[a-z]' and x rlike '[A-Z]' and x rlike '[0-9]', {value}, 0)"
        each.append(f"""case when size(m_{k}) > 0 then slice(transform(zip_with(m_{k}, s_{k}, (x, s) -> struct(
            length(s) as gap, coalesce(length(x), 0) as len, coalesce({value}, 0) as value)),
            (e, i) -> struct({n} as kind, i as i, e.gap as gap, e.len as len, e.value as value)), 1, size(m_{k})) else array() end""")
    e = d.select("doc_id", "th", F.explode_outer(F.expr(f"concat({', '.join(each)})")).alias("e")).filter("e is not null").select(
        "doc_id", "th", "e.*").distinct()
    walk = Window.partitionBy("doc_id", "th", "kind").orderBy("i")
    e = e.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(walk).cast("int"))
    least = F.element_at(F.lit([PATTERNS[k][1] for k in KINDS]), F.col("kind") + 1)
    return e.filter(F.col("value") >= least).select("doc_id", "th", "kind", (F.col("end") - F.col("len")).alias("start"), "end")


def _is(*kinds: str) -> Column:
    return F.col("kind").isin(*(KINDS.index(k) for k in kinds))


def _beside(which: Column, name: str) -> dict[str, Column]:
    """End of the nearest such candidate that starts before, start of the nearest that starts after."""
    doc = Window.partitionBy("doc_id", "th")
    before = doc.orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    after = doc.orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    return {f"{name}_before": F.max(F.when(which, F.col("end"))).over(before),
            f"{name}_after": F.min(F.when(which, F.col("start"))).over(after)}


def _overlaps(name: str) -> Column:
    return F.coalesce(F.col(f"{name}_before") > F.col("start"), F.lit(False)) | F.coalesce(
        F.col(f"{name}_after") < F.col("end"), F.lit(False))


def _near(name: str, scope: int) -> Column:
    return F.coalesce(F.col("start") - F.col(f"{name}_before") <= scope, F.lit(False)) | F.coalesce(
        F.col(f"{name}_after") - F.col("end") <= scope, F.lit(False))


def spans(docs: DataFrame, *, scope: int = SCOPE) -> DataFrame:
    """(doc_id, th, kind, start, end): base spans and the weak candidates whose complements co-occur.

    A weak candidate that overlaps a base span, or a bare value that overlaps a
    named part, is that span's text and is left out.
    """
    c = candidates(docs)
    c = c.withColumns(_beside(_is(*BASE), "base") | _beside(_is("identifier", "named"), "named"))
    c = c.filter(_is(*BASE) | ~(_overlaps("base") | (_is("bare") & _overlaps("named")))).select("doc_id", "th", "kind", "start", "end")
    c = c.withColumns(_beside(_is("access", "identifier"), "id") | _beside(_is("assign", "hex", "named", "bare"), "secret"))
    linked = ((_is("identifier") & _near("secret", scope)) | (_is("named", "bare") & _near("id", scope))
              | (_is("endpoint") & _near("id", scope) & _near("secret", scope)))
    return c.filter(_is(*BASE) | linked).select("doc_id", "th", "kind", "start", "end")


def report(docs: DataFrame, *, scope: int = SCOPE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row of ``docs`` (doc_id, text).

    ``spans`` joins kind:start:end by commas, in order of start and kind, base
    and linked spans together; ``base_sha256`` hashes the base ones so joined.
    Null and empty texts have none; repeated rows get the same figures; null
    ids are scanned like others. Other columns are ignored; an empty table
    gives no rows.
    """
    names = F.lit([NAMES.get(k, k) for k in KINDS])
    found = spans(docs, scope=scope).groupBy("doc_id", "th").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("all"),
        *(F.count_if(_is(k)).alias(f"n_{k}") for k in BASE))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(
            ":", F.element_at(names, x["kind"] + 1), x["start"], x["end"])), ",")

    found = found.select(F.col("doc_id").alias("found_id"), F.col("th").alias("found_th"), *(f"n_{k}" for k in BASE),
                         joined(F.filter("all", lambda x: x["kind"] < len(BASE))).alias("base"), joined(F.col("all")).alias("spans"))
    every = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("th"))
    return every.join(found, F.expr("th = found_th and doc_id <=> found_id"), "left").select(
        "doc_id", *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE),
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))
