"""Secret scans with an incremental ledger of blobs.

Every version of a file is addressed by the SHA-256 of its content. The ledger holds which blobs have
been scanned under which version of the rules, and what was found. A scan reads only blobs that the
ledger does not hold under the current rules, each once however many paths carry it, appends them, and
joins the findings of the ledger back to all paths. Only built-in functions run.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import replace_columns, shared_dir, written


@dataclass(frozen=True)
class Rule:
    """``pattern`` matches leftmost, without overlap; a match stays if its ``group`` has ``least``
    characters. A text without any of ``hints`` (or, without hints, without a match of ``probe``) has
    no match."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    hints: tuple[str, ...] = ()
    probe: str = ""


BASE_KINDS = ("assign", "access", "hex")

#: In the order in which kinds are listed at equal starts.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6,
         probe=r"(?i:password|passwd|secret|token|api_?key)"),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, hints=("AKIA",)),
    Rule("hex", r"[0-9a-f]{24,}+", 0, 24, probe=r"[0-9a-f]{24}"),
    # further kinds: each place of a text is read a bounded number of times, whatever the text
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[^-]*+(?:-(?!----)[^-]*+){0,64}-----END [A-Z ]{0,40}PRIVATE KEY-----",
         hints=("PRIVATE KEY",)),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+", hints=("eyJ",)),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}+", hints=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}+", hints=("xox",)),
    Rule("cloud", r"AIza[A-Za-z0-9_-]{35}", hints=("AIza",)),
    Rule("login", r"(?<![a-z0-9+.-])[a-z][a-z0-9+.-]{0,31}+://[^\s:/@]++:[^\s:/@]++@[^\s/]++", hints=("://",)),
)

#: Matches of a rule whose places are added up in one go.
STRETCH = 512

_SPAN = "struct<start:int,place:int,end:int,kind:string>"


def rules_version(rules: tuple[Rule, ...] = RULES) -> str:
    """Changes whenever any rule does."""
    return hashlib.sha256(json.dumps([asdict(r) for r in rules]).encode()).hexdigest()[:16]


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def _spans(text: Column, rule: Rule, place: int) -> Column:
    """Spans of one rule, in code points, end exclusive."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    judged = found if rule.group == 0 else F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    between = F.split(text, rule.pattern)  # text before, between and after the matches
    pieces = F.arrays_zip(F.transform(F.slice(between, F.lit(1), F.size(found)), F.length).alias("gap"),
                          F.transform(found, F.length).alias("long"), F.transform(judged, F.length).alias("judged"))

    none = F.array().cast(f"array<{_SPAN}>")

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + p["gap"]
        span = F.struct(start.alias("start"), F.lit(place).alias("place"), (start + p["long"]).alias("end"),
                        F.lit(rule.kind).alias("kind"))
        return F.struct((start + p["long"]).alias("at"),
                        F.when(p["judged"] >= rule.least, F.concat(acc["spans"], F.array(span)))
                        .otherwise(acc["spans"]).alias("spans"))

    def begin(acc: Column, stretch: Column) -> Column:
        covered = F.aggregate(stretch, F.lit(0), lambda n, p: n + p["gap"] + p["long"])
        return F.struct((acc["at"] + covered).alias("at"), F.concat(acc["begins"], F.array(acc["at"])).alias("begins"))

    def in_order(stretches: Column) -> Column:
        begins = F.aggregate(stretches, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("begins")),
                             begin, lambda a: a["begins"])
        return F.flatten(F.zip_with(stretches, begins, lambda x, at: F.aggregate(
            x, F.struct(at.alias("at"), none.alias("spans")), step, lambda a: a["spans"])))

    # growing an array copies it, so matches are added up in stretches: a text may hold very many
    firsts = lambda n: F.when(n > 0, F.sequence(F.lit(1), n, F.lit(STRETCH))).otherwise(F.array().cast("array<int>"))
    stretches = _let(pieces, lambda p: F.transform(firsts(F.size(p)), lambda i: F.slice(p, i, F.lit(STRETCH))))
    spans = _let(stretches, in_order)
    likely = text.rlike(rule.probe) if rule.probe else F.lit(False)
    for hint in rule.hints:
        likely = likely | text.contains(hint)
    return F.when(likely, spans).otherwise(none)


def find_secrets(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """All spans of a text by start, then in the order of the rules. The rules of ``BASE_KINDS`` keep
    every span that they find; others may overlap them."""
    return F.array_sort(F.concat(*[_spans(text, r, i) for i, r in enumerate(rules)]))


def open_ledger(spark: SparkSession, path: str) -> DataFrame:
    """What a ledger holds: blob, spans, rules. Each version of the rules has a folder of its own, so a scan
    opens that of its rules only. A folder that does not exist is an empty ledger."""
    schema = f"blob string, spans array<{_SPAN}>, rules string"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def update_ledger(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES,
                  id_col: str = "doc_id", text_col: str = "text") -> None:
    """Scan the blobs of ``versions`` that the ledger does not hold under these rules, and append them.

    Copies meet as (hash, smallest id) before any text moves, so a blob with any number of copies is
    one row; texts are then shuffled by hash and id, evenly. A run that is repeated after a failure
    finds whatever was committed and scans the rest.
    """
    spark = versions.sparkSession
    version = rules_version(rules)
    rows = versions.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("blob", F.sha2("text", 256))
    held = open_ledger(spark, ledger).filter(F.col("rules") == version).select("blob")
    unseen = rows.groupBy("blob").agg(F.min("id").alias("first_id")).join(held, "blob", "left_anti")
    texts = rows.alias("v").join(unseen.alias("u"), (F.col("v.blob") == F.col("u.blob"))
                                 & F.col("v.id").eqNullSafe(F.col("u.first_id")))
    scanned = texts.select(F.col("v.blob").alias("blob"), F.lit(version).alias("rules"),
                           find_secrets(F.col("v.text"), rules).alias("spans"))
    # rows with one id and one content find the same; one of them stays
    scanned.groupBy("blob", "rules").agg(F.first("spans").alias("spans")).write.mode("append").partitionBy("rules").parquet(ledger)


def scan_secrets(versions: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``versions`` and blob (SHA-256 of the text), secrets (array of start, place, end,
    kind; by start, then kind as listed).

    ``ledger``: a folder that keeps findings between scans, by default a new one in the shared folder.
    A null text is scanned as an empty one. Rows with equal texts, equal or null ids get equal findings,
    row by row. An empty table gives no rows. An input column with the name of a result column (in any
    case) is replaced by it. A blob that many paths carry is joined by a sort-merge join whose large
    side adaptive execution splits.
    """
    spark = versions.sparkSession
    ledger = ledger or shared_dir(spark)
    update_ledger(versions, ledger, rules, id_col, text_col)
    # written, so that no aggregate stands between the join and its shuffle: then a blob that many
    # paths carry can be split
    found = written(open_ledger(spark, ledger).filter(F.col("rules") == rules_version(rules))
                    .groupBy("blob").agg(F.first("spans").alias("secrets")))
    rows = versions.select(F.struct(*[F.col(f"`{c}`") for c in versions.columns]).alias("row"),
                           F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("blob"))
    joined = rows.join(found, "blob", "left")
    return replace_columns(joined, "row", ["blob", "secrets"])


def of_kind(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
