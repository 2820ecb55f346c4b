"""Secrets in texts, and credentials whose parts lie close together.  Built-in functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordinate.llm.common import stored

#: Kinds that count wherever they are found, in the order in which they are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
BASE = ["assign", "access", "hex"]

#: Code points between two parts of one credential.
REACH = 256


@dataclass(frozen=True)
class Kind:
    """What a pattern finds: leftmost matches that do not overlap, of which ``keep`` chooses.

    ``role`` says which part of a credential it is: id, secret or endpoint.  A weak kind counts only
    beside a part of another role.  ``hint`` is a cheap pattern without which there is no match.
    """

    name: str
    pattern: str
    role: str
    weak: bool = False
    group: int = 0
    least: int = 1
    hint: str | None = None


KINDS = [
    Kind("assign", ASSIGN, "secret", group=2, least=6, hint=r"(?i)(?:passw|secret|token|api_?key)"),
    Kind("access", ACCESS, "id", least=20, hint="AKIA"),
    # the longest run from each place is the same with the least length in the pattern
    Kind("hex", r"[0-9a-f]{24,}", "secret", least=24),
    Kind("key_id", r"(?<![A-Za-z0-9])A(?:SIA|ROA|IDA|KIA)[A-Z0-9]{8,}(?![a-z])", "id", weak=True, hint=r"A(?:SIA|ROA|IDA|KIA)[A-Z0-9]{8}"),
    Kind("user", r"(?i)\b(?:user(?:name)?|login|client_id|account)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9@_.+-]{3,}", "id", weak=True,
         hint=r"(?i)(?:user|login|client_id|account)[a-z]{0,4}[\"']?\x20*[:=]"),
    Kind("blob", r"(?<![A-Za-z0-9+/])(?=[A-Za-z+/]*[0-9])[A-Za-z0-9+/]{32,}={0,2}", "secret", weak=True, hint=r"[A-Za-z0-9+/]{32}"),
    Kind("endpoint", r"https?://[^\s\"'<>]+|\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?::[0-9]{2,5})?\b", "endpoint", weak=True,
         hint=r"https?://|[0-9]\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]"),
]


#: A span of a role needs one of these beside it, if it is weak.
PARTNERS = {"id": ["secret"], "secret": ["id", "endpoint"], "endpoint": ["secret"]}

DOC = ["key", "mark"]


def _matches(text: Column, number: int, kind: Kind) -> Column:
    """The matches of a kind in their order: the gap before each, its length, and whether it counts.

    Pieces between matches, and matches, take turns; a text without the hint is read once.
    """
    found = F.regexp_extract_all(text, F.lit(kind.pattern), 0)
    part = F.regexp_extract_all(text, F.lit(kind.pattern), kind.group) if kind.group else found
    sized = F.zip_with(found, part, lambda m, p: F.struct(F.length(m).alias("n"), (F.length(p) >= kind.least).alias("ok")))
    gaps = F.transform(F.split(text, kind.pattern, -1), lambda piece: F.length(piece))
    rows = F.transform(
        F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), sized.alias("m")),
        lambda x, i: F.struct(
            F.lit(number).alias("number"), i.alias("place"), x["gap"].cast("long").alias("gap"),
            x["m"]["n"].cast("long").alias("n"), x["m"]["ok"].alias("ok")),
    )
    none = F.array().cast("array<struct<number:int,place:int,gap:bigint,n:bigint,ok:boolean>>")
    return F.when(text.rlike(kind.hint or kind.pattern), rows).otherwise(none)


def _role(column: str, kinds: list[Kind], what) -> Column:
    return F.element_at(F.array(*[F.lit(what(k)) for k in kinds]), F.col(column) + 1)


def parts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", kinds: list[Kind] = KINDS) -> tuple[DataFrame, DataFrame]:
    """All documents as ``(key, mark, matches)``, and their spans ``(key, mark, number, start, stop, weak, role)``.

    ``mark`` tells texts of one key apart.  Starts are running sums over a document's matches of one kind.
    """
    from pyspark.sql import Window

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    docs, _ = stored(
        df.select(
            F.col(id_col).alias("key"), F.xxhash64(text).alias("mark"),
            F.concat(*[_matches(text, n, k) for n, k in enumerate(kinds)]).alias("matches"),
        ), "matches")
    before = Window.partitionBy("key", "mark", "number").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    spans = (
        docs.where(F.size("matches") > 0).select("key", "mark", F.explode("matches").alias("m")).select("key", "mark", "m.*").distinct()
        .withColumn("stop", F.sum(F.col("gap") + F.col("n")).over(before))
        .where("ok")
        .select(
            "key", "mark", "number", (F.col("stop") - F.col("n")).alias("start"), "stop",
            _role("number", kinds, lambda k: k.weak).alias("weak"), _role("number", kinds, lambda k: k.role).alias("role"))
    )
    return docs, stored(spans, "spans")[0]


def _in_bins(spans: DataFrame, margin: int, reach: int) -> DataFrame:
    """One row for each stretch of the text that a span, widened by the margin, touches."""
    first = F.floor((F.col("start") - margin) / reach)
    last = F.floor((F.col("stop") + margin) / reach)
    return spans.withColumn("bin", F.explode(F.sequence(first, last)))


def linked(spans: DataFrame, reach: int = REACH) -> DataFrame:
    """The spans that are reported: all strong ones, and weak ones beside a part of another role.

    Weak spans of one document meet the parts that are at most ``reach`` code points away in stretches of that
    length; each stretch holds a bounded number of parts, and a weak span is kept on its first partner, so
    that no pairs come out.  Weak spans that overlap a strong one are the same secret and go.
    """
    weak, strong = spans.where("weak"), spans.where("not weak")
    near = _in_bins(spans, reach, reach).select(
        *[F.col(c).alias(f"p_{c}") for c in ("key", "mark", "start", "stop", "role", "weak", "bin")])
    same = F.col("key").eqNullSafe(F.col("p_key")) & (F.col("mark") == F.col("p_mark")) & (F.col("bin") == F.col("p_bin"))
    overlap = (F.col("p_start") < F.col("stop")) & (F.col("start") < F.col("p_stop"))
    close = (F.col("p_start") - reach < F.col("stop")) & (F.col("start") < F.col("p_stop") + reach)
    partner = F.lit(False)
    for role, others in PARTNERS.items():
        partner = partner | ((F.col("role") == role) & F.col("p_role").isin(others))
    alone = _in_bins(weak, 0, reach).join(near.where("not p_weak"), same & overlap, "left_semi").select(*spans.columns).distinct()
    free = weak.join(alone.select(*[F.col(c).alias(f"a_{c}") for c in ("key", "mark", "number", "start")]),
                     F.col("key").eqNullSafe(F.col("a_key")) & (F.col("mark") == F.col("a_mark"))
                     & (F.col("number") == F.col("a_number")) & (F.col("start") == F.col("a_start")), "left_anti")
    reported = _in_bins(free, 0, reach).join(near, same & close & partner, "left_semi").select(*spans.columns).distinct()
    return strong.unionByName(reported)


def credentials(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", kinds: list[Kind] = KINDS, reach: int = REACH
) -> DataFrame:
    """Every row's secrets: ``(key, mark, spans)``, spans as ``(start, number, stop)`` in code points, in that order.

    ``number`` is the place in ``kinds``; ends are exclusive.  Null and empty texts have no span, repeated rows
    have theirs each, rows with a null key too.  Columns other than the two named are not read.  ``mark`` is
    the text's hash, by which the spans can be joined to it.
    """
    docs, spans = parts(df, id_col, text_col, kinds)
    found = linked(spans, reach).groupBy(F.col("key").alias("f_key"), F.col("mark").alias("f_mark")).agg(
        F.sort_array(F.collect_list(F.struct("start", "number", "stop"))).alias("spans"))
    none = F.array().cast("array<struct<start:bigint,number:int,stop:bigint>>")
    return docs.select(*DOC).join(
        found, F.col("key").eqNullSafe(F.col("f_key")) & (F.col("mark") == F.col("f_mark")), "left"
    ).select("key", "mark", F.coalesce("spans", none).alias("spans"))


def redacted(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, kinds: list[Kind] = KINDS, reach: int = REACH
) -> DataFrame:
    """The rows with every reported id and secret replaced by its kind's name in brackets: ``(key, mark, text, *keep)``.

    Endpoints stay, they only point to what is secret.  Where spans overlap, the first one's name stands for all.
    Null texts become empty.  Repeated rows stay.
    """
    from pyspark.sql import Window

    _, spans = parts(df, id_col, text_col, kinds)
    before = Window.partitionBy("key", "mark").orderBy("start", "number", "stop").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (
        linked(spans, reach).where("role <> 'endpoint'")
        .withColumn("at", F.coalesce(F.max("stop").over(before), F.lit(0)))
        .groupBy(F.col("key").alias("f_key"), F.col("mark").alias("f_mark"))
        .agg(F.sort_array(F.collect_list(F.struct("start", "number", "at"))).alias("cuts"), F.max("stop").alias("last"))
    )
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    docs = df.select(F.col(id_col).alias("key"), F.xxhash64(text).alias("mark"), text.alias("text"), *(keep or []))
    names = F.array(*[F.lit(f"[{k.name}]") for k in kinds])

    def piece(c):
        gap = F.substring(F.col("text"), c["at"].cast("int") + 1, (c["start"] - c["at"]).cast("int"))
        return F.when(c["start"] >= c["at"], F.concat(gap, F.element_at(names, c["number"] + 1))).otherwise(F.lit(""))

    tail = F.substring(F.col("text"), F.col("last").cast("int") + 1, F.length("text"))
    clean = F.when(F.col("cuts").isNull(), F.col("text")).otherwise(F.concat(F.array_join(F.transform("cuts", piece), ""), tail))
    same = F.col("key").eqNullSafe(F.col("f_key")) & (F.col("mark") == F.col("f_mark"))
    return docs.join(cuts, same, "left").select("key", "mark", clean.alias("text"), *(keep or []))
