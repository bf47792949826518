"""Secret scans over an incremental ledger of text blobs, in DataFrame operations only.

A version of a path is content-addressed (sha256 of its text). The ledger holds which (blob,
rule version) pairs have been scanned and what was found. A scan takes the pairs not yet in the
ledger, reads one copy of each such blob, appends to the ledger, and findings are joined back to
every path and version that has the blob. Copies and unchanged versions are scanned once.

Positions come from cutting a text at a rule's matches: the pieces' and matches' lengths, summed
up by a window, are the spans (code points, end exclusive), leftmost and non-overlapping for each rule.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame, Window, functions as F

from sitecorpus.llm.stored import store


@dataclasses.dataclass(frozen=True)
class Rule:
    """``pattern`` finds matches; one counts if ``part`` (its group) has ``least`` characters.
    ``hint`` is a pattern found in every text that has a counting match (``pattern`` itself, if none
    is given): other texts are not cut up."""

    kind: str
    version: int
    pattern: str
    part: int
    least: int
    hint: str | None = None


#: The base rules (fixed values), in the order in which kinds are listed.
RULES = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12,
         r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12}"""),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 18, r"AKIA[A-Z0-9]{14}"),
    Rule("hex", 1, r"[0-9a-f]+", 0, 16, r"[0-9a-f]{16}"),
)
BLOCK = 1024  # characters of a block of a text that is redacted
GROUP = 64    # spans of a text that are redacted together
#: A rule's version as a blob's list of rules to scan names it.
NAME = "{r.kind}:{r.version}"


def _matches(text: Column, rule: Rule) -> Column:
    """For each match of the rule: the characters before it since the match before, its own, and those of its
    ``part``. Texts without any long enough match skip the cutting."""
    found, gaps = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), F.split(text, rule.pattern, -1)
    values = found if rule.part == 0 else F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.part))
    lengths = F.arrays_zip(F.transform(F.slice(gaps, F.lit(1), F.size(found)), F.length).alias("gap"),
                           F.transform(found, F.length).alias("all"), F.transform(values, F.length).alias("part"))
    return F.when(text.rlike(rule.hint or rule.pattern), lengths)


def _hinted(text: Column, rules: tuple[Rule, ...]) -> Column:
    """Whether a text can hold a secret at all."""
    hits = F.lit(False)
    for r in rules:
        hits |= text.rlike(r.hint or r.pattern)
    return hits


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, kind, version, start, end) of every secret in (blob, text, todo); each text is read under the
    rules that its ``todo`` names (``kind:version``) and no others.

    A match's place is the sum of the lengths before it, by a window over the blob's matches under the
    rule, so the work is linear in a text however many matches it has."""
    found = F.array(*[F.struct(F.lit(i).alias("rule"), F.when(
        F.array_contains("todo", NAME.format(r=r)), _matches(F.col("text"), r)).alias("matches")) for i, r in enumerate(rules)])
    each = blobs.select("blob", F.monotonically_increasing_id().alias("copy"), F.explode(found).alias("f"))
    rows = each.select("blob", "copy", "f.rule", F.posexplode("f.matches").alias("n", "m")).select("blob", "copy", "rule", "n", "m.*")
    upto = Window.partitionBy("blob", "copy", "rule").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("end", F.sum(F.col("gap") + F.col("all")).over(upto).cast("int"))
    of = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (i, r.least)])
    names = F.create_map(*[y for i, r in enumerate(rules) for y in (F.lit(i), F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")))])
    name = F.element_at(names, F.col("rule"))
    return placed.filter(F.col("part") >= F.element_at(of, F.col("rule"))).select(
        "blob", name["kind"].alias("kind"), name["version"].alias("version"),
        (F.col("end") - F.col("all")).alias("start"), "end")


@dataclasses.dataclass
class Ledger:
    """``scanned`` (blob, kind, version) and ``findings`` (blob, kind, version, start, end)."""

    scanned: DataFrame | None = None
    findings: DataFrame | None = None


def address(versions: DataFrame, text: str = "text") -> Column:
    """The content address of a text; null counts as empty."""
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def unseen_pairs(versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """(blob, key, todo): the blobs of ``versions`` that some rule version has not scanned, the smallest key of
    a row that has it, and the rule versions (``kind:version``) that have not."""
    wanted = versions.groupBy(address(versions, text).alias("blob")).agg(
        F.min(F.struct(F.col(key).isNull().alias("no_key"), F.col(key).alias("key"))).alias("at"))
    every = F.array(*[F.lit(NAME.format(r=r)) for r in rules])
    if ledger.scanned is None:
        return wanted.select("blob", "at.key", every.alias("todo"))
    done = ledger.scanned.groupBy("blob").agg(F.collect_set(F.concat_ws(":", "kind", F.col("version").cast("string"))).alias("done"))
    left = F.array_except(every, F.coalesce("done", F.array().cast("array<string>")))
    return wanted.join(done, "blob", "left").select("blob", "at.key", left.alias("todo")).filter(F.size("todo") > 0)


def update(versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES, key: str = "doc_id",
           text: str = "text") -> Ledger:
    """The ledger after scanning the (blob, rule version) pairs of ``versions`` that it lacks. A blob is read
    from one row that has it (the smallest key), whatever the number of copies. With nothing scanned yet, texts
    that no rule's hint is found in are told apart where they lie and are not sent to the join."""
    pairs = store(unseen_pairs(versions, ledger, rules, key, text), "blob-todo")
    texts = versions.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    if ledger.scanned is None:
        texts = texts.filter(_hinted(F.col("text"), rules))
    one = (texts.join(pairs.hint("shuffle_hash"), texts["key"].eqNullSafe(pairs["key"]))
           .filter(F.col("blob") == F.sha2("text", 256)).select("blob", "text", "todo"))
    found = store(scan(one, rules).distinct(), "findings")  # repeated rows give a blob more than once
    done = pairs.select("blob", F.explode("todo").alias("r")).select(
        "blob", F.split("r", ":")[0].alias("kind"), F.split("r", ":")[1].cast("int").alias("version"))
    if ledger.scanned is None:
        return Ledger(done, found)
    return Ledger(store(ledger.scanned.unionByName(done), "scanned"),
                  store(ledger.findings.unionByName(found), "findings"))


def by_blob(ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, spans): the current rules' findings of each blob that has any, by start and then by
    the rules' order; a span is (start, rank, kind, end)."""
    rank = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)])
    current = F.lit(False)
    for r in rules:
        current |= (F.col("kind") == r.kind) & (F.col("version") == r.version)
    return ledger.findings.filter(current).groupBy("blob").agg(F.array_sort(F.collect_list(F.struct(
        "start", F.element_at(rank, F.col("kind")).alias("rank"), "kind", "end"))).alias("spans"))


def find_secrets(versions: DataFrame, ledger: Ledger | None = None, rules: tuple[Rule, ...] = RULES,
                 key: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> tuple[DataFrame, Ledger]:
    """One row per row of ``versions``: key, the ``keep`` columns, blob, spans (an array of (start,
    rank, kind, end), empty if clean), and the updated ledger.

    A null text is an empty blob. Repeated rows and null keys stay; an empty table gives an empty
    result; other columns are ignored. A text's findings are held in one row."""
    first = ledger is None or ledger.scanned is None
    ledger = update(versions, ledger or Ledger(), rules, key, text)
    # written, so that the copies of one blob can be split over tasks in the join
    found = store(by_blob(ledger, rules), "blob-spans")
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")

    def addressed(rows):
        return rows.select(F.col(key), *(keep or []), address(rows, text).alias("blob"))
    if first:  # all findings are of the rules at hand: only texts with a hint are joined to them
        hint = _hinted(F.coalesce(F.col(text), F.lit("")), rules)
        out = addressed(versions.filter(hint)).join(found, "blob", "left").unionByName(
            addressed(versions.filter(~hint)).withColumn("spans", none))
    else:
        out = addressed(versions).join(found, "blob", "left")
    return out.select(key, *(keep or []), "blob", F.coalesce("spans", none).alias("spans")), ledger


def digest(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each maximal run of overlapping spans replaced by the mark. ``spans`` ascend by
    start. Spans are taken ``GROUP`` at a time, with the farthest end of all before them, and the text in
    blocks of ``BLOCK`` characters, so a span costs what lies between it and the one before."""
    def between(blocks, a, b):
        i, j = F.floor(a / BLOCK).cast("int"), F.floor(b / BLOCK).cast("int")
        first, last = F.coalesce(F.get(blocks, i), F.lit("")), F.coalesce(F.get(blocks, j), F.lit(""))
        return F.when(i == j, F.substring(first, a % BLOCK + 1, b - a)).otherwise(F.concat(
            F.substring(first, a % BLOCK + 1, F.lit(BLOCK)), F.array_join(F.slice(blocks, i + 2, F.greatest(j - i - 1, F.lit(0))), ""),
            F.substring(last, F.lit(1), b % BLOCK)))

    def farthest(some):
        return F.coalesce(F.array_max(F.transform(some, lambda x: x["end"])), F.lit(0))

    def piece(s, x, ahead):
        return F.when(x["start"] >= ahead, F.concat(between(s["blocks"], ahead, x["start"]), F.lit(mark))).otherwise("")

    def cut(s):
        groups = F.transform(s["groups"], lambda g, k: F.array_join(F.transform(g, lambda x, i: piece(
            s, x, F.greatest(F.get(s["ahead"], k), farthest(F.slice(g, F.lit(1), i))))), ""))
        return F.concat(F.array_join(groups, ""), between(s["blocks"], F.element_at(s["ahead"], -1), s["n"]))
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    groups = F.transform(F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / GROUP).cast("int")),
                         lambda k: F.slice(spans, k * GROUP + 1, GROUP))
    ahead = F.aggregate(F.transform(groups, farthest), F.array(F.lit(0)), lambda out, e: F.concat(
        out, F.array(F.greatest(F.element_at(out, -1), e))))
    whole = F.array(F.struct(blocks.alias("blocks"), groups.alias("groups"), ahead.alias("ahead"), F.length(text).alias("n")))
    return F.when(F.size(spans) == 0, text).otherwise(F.get(F.transform(whole, cut), F.lit(0)))
