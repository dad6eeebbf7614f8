"""Secret scan with an incremental ledger of text blobs, in DataFrame operations only.

Every text, of whatever version of whatever path, is a blob addressed by its SHA-256. The ledger says which
rules, in which version, a blob has been scanned with, and what was found. Only unseen pairs of blob and
rule version are scanned, each blob once however many paths hold it, and findings are joined back to all
paths by the blob's address. A ledger row holds ``blob``, the ``rules`` (``kind@version``) scanned and the
``findings`` (``start, kind_no, end, kind, rule``, positions in code points, ends exclusive); a blob may have
several rows. Of the ledger's findings only those of rules asked for now, in their present version, are
reported, each once: a new version's findings take the place of the old one's, those of a rule that is no
longer asked for rest, and rows appended twice count once.

Positions come from the text between the matches: splitting at a pattern and extracting all matches gives
the pieces and the matches in turn, and a running sum of their lengths over a window gives the starts.
Of the pieces only the lengths leave the text's row.

Rules: a rule's matches are leftmost and do not overlap; matches whose group ``part`` is shorter than
``least`` are dropped. The last two kinds are additions to the three basic ones.

Edge cases: a null text is an empty one; empty texts hold nothing. Texts are scanned whole. Rows that repeat
an id, or have a null one, keep their row each. ``scan`` replaces input columns named ``blob`` and
``findings`` by its own; ``redacted`` keeps all columns. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ingotflow.llm.common import written


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    part: int = 0
    least: int = 0
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


BASE = [
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         part=2, least=8),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),  # the run is taken whole, so short runs need not match first
    Rule("hex", r"[0-9a-f]{32,}"),
]
MORE = [
    Rule("forge", r"\bgh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
]
RULES = BASE + MORE
FINDINGS = "array<struct<start:bigint,kind_no:int,end:bigint,kind:string,rule:string>>"
MASK = "[secret]"
#: Parts into which the copies of one text are dealt when findings are joined to them.
PARTS = 16


def address(text: str = "text") -> Column:
    """The blob address of a text."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


def _matches(rule: Rule) -> Column:
    """The length of the piece before each match, and the matches, of ``text``; null where there are none."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all("text", pattern, F.lit(0))
    before = F.transform(F.slice(F.split("text", rule.pattern, -1), F.lit(1), F.size(found)), F.length)
    return F.when(F.col("text").rlike(rule.pattern), F.arrays_zip(before.alias("before"), found.alias("match")))


def scan_blobs(blobs: DataFrame, rules: list[Rule]) -> DataFrame:
    """``blob, findings`` of the blobs with findings; ``blobs``: ``blob, text, seen`` (rules scanned)."""
    hits = blobs.where("text is not null").select("blob", F.explode(F.filter(F.array(*(
        F.struct(F.lit(i).alias("kind_no"), F.when(
            ~F.coalesce(F.array_contains("seen", rule.name), F.lit(False)), _matches(rule)).alias("runs"))
        for i, rule in enumerate(rules))), lambda x: x["runs"].isNotNull())).alias("hit"))
    runs = hits.select("blob", "hit.kind_no", F.posexplode("hit.runs").alias("no", "run"))
    so_far = Window.partitionBy("blob", "kind_no").orderBy("no").rowsBetween(Window.unboundedPreceding, 0)
    spans = runs.select("blob", "kind_no", "run.match", F.sum(F.col("run.before") + F.length("run.match"))
                        .over(so_far).alias("end")).withColumn("start", F.col("end") - F.length("match"))
    long_enough = F.lit(True)
    for i, rule in enumerate(rules):
        if rule.least:
            long_enough &= (F.col("kind_no") != i) | (
                F.length(F.regexp_extract("match", rule.pattern, rule.part)) >= rule.least)
    kinds, names = (F.array(*map(F.lit, x)) for x in ([r.kind for r in rules], [r.name for r in rules]))
    return (spans.where(long_enough).groupBy("blob").agg(F.array_sort(F.collect_list(F.struct(
        "start", "kind_no", "end", F.get(kinds, "kind_no").alias("kind"), F.get(names, "kind_no").alias("rule")
    ))).alias("findings")))


def scan(documents: DataFrame, ledger: DataFrame | None = None, rules: list[Rule] = RULES,
         text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The documents with ``blob`` and ``findings``, and the ledger rows to append."""
    names = F.array(*(F.lit(rule.name) for rule in rules))
    none = F.array().cast(FINDINGS)
    held = documents.select(*(c for c in documents.columns if c not in ("blob", "findings")),
                            address(text).alias("blob"))
    blobs = held.select("blob", F.col(text).alias("text")).dropDuplicates(["blob"])
    known = None
    if ledger is None:
        blobs = blobs.withColumn("seen", F.array().cast("array<string>"))
    else:
        known = ledger.groupBy("blob").agg(
            F.array_distinct(F.flatten(F.collect_set("rules"))).alias("seen"),
            F.array_distinct(F.flatten(F.collect_set("findings"))).alias("old"))
        blobs = (blobs.join(known.select("blob", "seen"), "blob", "left")
                 .where(F.coalesce(F.size(F.array_except(names, "seen")) > 0, F.lit(True))))
    found = written(blobs.select("blob", F.array_except(names, F.coalesce("seen", F.array().cast("array<string>")))
                                 .alias("rules")).join(scan_blobs(blobs, rules), "blob", "left")
                    .select("blob", "rules", F.coalesce("findings", none).alias("findings")), "ledger")
    hits = found.where(F.size("findings") > 0).select("blob", "findings")
    if known is not None:
        # rules keep their number by their name, which the ledger's may have had at another place
        number = F.create_map(*(F.lit(x) for i, rule in enumerate(rules) for x in (rule.name, i)))
        old = F.array_distinct(F.transform(
            F.filter("old", lambda x: F.array_contains(names, x["rule"])), lambda x: F.struct(
                x["start"].alias("start"), number[x["rule"]].alias("kind_no"), x["end"].alias("end"),
                x["kind"].alias("kind"), x["rule"].alias("rule"))))
        both = hits.union(known.select("blob", old.alias("findings")).where(F.size("findings") > 0))
        hits = both.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("findings"))).alias("findings"))
    # a text may have any number of copies: they are dealt to several tasks, and its findings to each
    part = F.pmod(F.monotonically_increasing_id(), F.lit(PARTS))
    parts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(PARTS - 1).cast("bigint")))
    out = held.withColumn("_part", part).join(hits.withColumn("_part", parts), ["blob", "_part"], "left")
    columns = [c for c in held.columns if c != "blob"]
    return out.select(*columns, "blob", F.coalesce("findings", none).alias("findings")), found


def masked(text: Column, findings: Column) -> Column:
    """The text with every run of overlapping findings replaced by ``MASK``."""
    start = F.struct(F.lit(1).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(done: Column, span: Column) -> Column:
        begin = span["start"] + 1
        apart = begin >= done["at"]
        out = F.when(apart, F.concat(done["out"], F.substring(text, done["at"], begin - done["at"]), F.lit(MASK)))
        return F.struct(F.greatest(done["at"], span["end"] + 1).alias("at"), out.otherwise(done["out"]).alias("out"))

    return F.aggregate(findings, start, step, lambda done: F.concat(
        done["out"], F.substring(text, done["at"], F.length(text).cast("bigint"))))


def redacted(documents: DataFrame) -> DataFrame:
    """The documents with the secrets in their texts masked and ``n_chars``, if there is one, counted anew;
    other columns unchanged, whatever their names."""
    private = documents.select(*(F.col(c).alias(f"_{i}") for i, c in enumerate(documents.columns)))
    at = documents.columns.index("text")
    found, _ = scan(private, text=f"_{at}")
    text = F.when(F.size("findings") > 0, masked(F.col(f"_{at}"), F.col("findings")))

    def value(i: int, name: str) -> Column:
        if i == at:
            return F.coalesce("_masked", f"_{i}")
        if name == "n_chars":
            return F.coalesce(F.length("_masked").cast(documents.schema[name].dataType), f"_{i}")
        return F.col(f"_{i}")

    return found.withColumn("_masked", text).select(
        *(value(i, name).alias(name) for i, name in enumerate(documents.columns)))
