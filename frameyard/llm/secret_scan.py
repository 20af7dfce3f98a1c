"""Secret scans with a trigram inverted index, in DataFrame functions only.

Each rule's regex gives a Boolean trigram query: alternatives (OR) of trigrams that any match must hold (AND). The
index has a posting (trigram, row key) for every trigram that a query names; postings are intersected by counting,
per alternative, how many of its trigrams a text has; and only the candidates of a rule are verified with its regex.
A rule without a mandatory trigram scans every text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameyard.llm.common import bounded_broadcast, materialize


@dataclass(frozen=True)
class Rule:
    kind: str
    #: A regex of Java's and Python's common subset; group, if not 0, is what must have least characters.
    regex: str
    group: int
    least: int
    #: The same matches with the bound of least inside, so that short ones are never collected.
    bounded: str = ""


#: Fixed values, in the order in which ties of a start are listed.
BASE = (
    Rule("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]+", 0, 24, r"[0-9a-f]{24,}"),
)
#: The method's own kinds.
RULES = (
    *BASE,
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}", 0, 40),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}", 0, 39),
    Rule("slack", r"xox[abprs]-[0-9A-Za-z-]{10,}", 0, 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 29),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 27),
)
#: Alternatives of a literal stretch that are followed one by one; a wider choice ends the stretch.
WIDEST = 16
#: Letters, the most common ones of English first.
COMMON = "etaoinsrhldcumfpgwybvkxjqz"
#: Matches that are added up one by one; the sums of such runs are added up again.
RUN = 256


def _strings(parsed) -> tuple[list[str] | None, list[frozenset[str]]]:
    """Of a parsed regex: all strings it can match, if few, else None; and its trigram alternatives (in lower case).

    Alternatives are a list of sets, one of which must be wholly present; [frozenset()] says nothing is mandatory.
    """
    from re import _constants as c

    def both(a, b):
        got = {x | y for x in a for y in b}
        return list(got) if len(got) <= 64 else a

    need: list[frozenset[str]] = [frozenset()]
    run: list[str] | None = [""]  # strings of the stretch at hand
    whole = True

    def close():
        nonlocal need, run
        if run and all(len(s) >= 3 for s in run):
            need = both(need, [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in run])
        run = [""]

    for op, arg in parsed:
        exact, inner = None, [frozenset()]
        if op is c.LITERAL:
            exact = [chr(arg).lower()]
        elif op is c.IN and all(k is c.LITERAL for k, _ in arg):
            exact = sorted({chr(v).lower() for _, v in arg})
        elif op is c.SUBPATTERN:
            exact, inner = _strings(arg[3])
        elif op is c.BRANCH:
            parts = [_strings(p) for p in arg[1]]
            exact = [s for e, _ in parts for s in e] if all(e is not None for e, _ in parts) else None
            inner = [n for _, ns in parts for n in ns]
        elif op in (c.MAX_REPEAT, c.MIN_REPEAT):
            lo, hi, sub = arg
            got, inside = _strings(sub)
            if hi == 1 and lo == 0 and got is not None:
                exact = ["", *got]
            elif lo:
                inner = inside
        if exact is not None and len(exact) * len(run) <= WIDEST:
            run = [a + b for a, b in product(run, exact)]
        else:
            close()
            need, whole = both(need, inner), False
    strings = run if whole else None
    close()
    return strings, need


def trigram_query(regex: str) -> list[frozenset[str]]:
    """Alternatives of trigrams, in lower case, one of which a matching text holds wholly; [] if it must be scanned."""
    from re import _parser

    need = _strings(_parser.parse(regex.replace(r"\x20", " ")))[1]
    if any(not n for n in need):
        return []
    return sorted((n for n in need if not any(m < n for m in need)), key=sorted)


def _leads(alternatives: list[set[str]]) -> dict[str, list[str]]:
    """A lead for every alternative, with the other trigrams that alternatives of this lead name. Leads of rare letters
    and of many alternatives come first; any choice gives the same candidates, these are read for few texts."""
    rank = lambda t: sum(COMMON.index(c) if c in COMMON else len(COMMON) for c in t)
    left, out = list(alternatives), {}
    while left:
        lead = max(sorted({t for alt in left for t in alt}), key=lambda t: rank(t) * sum(t in alt for alt in left))
        out[lead] = sorted({t for alt in left if lead in alt for t in alt} - {lead})
        left = [alt for alt in left if lead not in alt]
    return out


def _key(id_col: str, text: Column) -> list[Column]:
    return [F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("_hash")]


def _let(value: Column, use) -> Column:
    """use(value) with value worked out once: a column named inside a lambda is worked out at each of its calls."""
    return F.transform(F.array(value), use)[0]


def candidates(docs: DataFrame, rules, id_col: str, text: Column) -> DataFrame | None:
    """(doc_id, _hash, _rules): the numbers of the indexed rules whose query a row's trigrams fulfil, one row per key."""
    spark = docs.sparkSession
    queries = [(n, a, t) for n, r in enumerate(rules) for a, alt in enumerate(trigram_query(r.regex)) for t in sorted(alt)]
    if not queries:
        return None
    need = {}
    for n, a, t in queries:
        need.setdefault((n, a), set()).add(t)
    led = _leads(list(need.values()))

    def named(low: Column) -> Column:
        """The trigrams of a text that its queries ask for: those of the alternatives whose lead stands in it."""
        of = [F.when(F.contains(low, F.lit(lead)), F.array(F.lit(lead), *(F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in more))) for lead, more in led.items()]
        return F.array_distinct(F.array_compact(F.flatten(F.array_compact(F.array(*of)))))

    # postings of the trigrams that the queries name; explode drops the texts without any
    postings = docs.select(*_key(id_col, text), F.explode(_let(F.lower(text), named)).alias("trigram"))
    terms = spark.createDataFrame([(t, n, a, len(need[n, a])) for n, a, t in queries], "trigram string, rule int, alt int, need int")
    return (
        postings.join(F.broadcast(terms), "trigram")  # the rules' own terms: a few hundred rows at most
        .groupBy("doc_id", "_hash", "rule", "alt").agg(F.count_distinct("trigram").alias("n"), F.max("need").alias("need"))
        .where("n = need")
        .groupBy("doc_id", "_hash").agg(F.sort_array(F.collect_set("rule")).alias("_rules"))
    )


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """array<struct<start, kind_no, end>> in code points of a rule's leftmost matches, short ones dropped."""
    regex = rule.bounded or rule.regex
    found = F.regexp_extract_all(text, F.lit(regex), F.lit(0))
    checked = F.regexp_extract_all(text, F.lit(regex), F.lit(rule.group)) if rule.group else found
    gaps = F.transform(F.split(text, regex, -1), F.length)
    # one step per match: skip the text before it, note it, go on behind it; behind the last one there is no match
    steps = F.zip_with(F.zip_with(F.transform(found, F.length), F.transform(checked, F.length), lambda a, b: F.struct(a.alias("n"), b.alias("c"))),
                       gaps, lambda m, gap: F.struct(F.coalesce(m["n"], F.lit(0)).alias("n"), m["c"].alias("c"), gap.alias("gap")))
    seed = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")

    def step(acc, m):
        start = acc["at"] + m["gap"]
        end = start + m["n"]
        hit = F.struct(start.alias("start"), F.lit(order).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(m["c"] >= rule.least, F.concat(acc["out"], F.array(hit))).otherwise(acc["out"]).alias("out"))

    def cut(steps):
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / RUN).cast("int")), lambda r: F.slice(steps, r * RUN + 1, F.lit(RUN)))

    def walk(runs):
        total = F.transform(runs, lambda run: F.aggregate(run, F.lit(0), lambda acc, m: acc + m["gap"] + m["n"]))
        begin = F.aggregate(total, seed, lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))["out"]
        return F.flatten(F.zip_with(runs, begin, lambda run, at: F.aggregate(run, F.struct(at.alias("at"), empty.alias("out")), step)["out"]))

    return F.when(text.rlike(regex), _let(_let(steps, cut), walk)).otherwise(empty)


def find_spans(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """docs' rows as doc_id, text and spans: array<struct<start, kind, end>> sorted by start, then kind's number.
    With carry, docs' own columns come along in the struct row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(*_key(id_col, text), text.alias("text"), *([F.struct(*docs.columns).alias("row")] if carry else []))
    found = candidates(docs, rules, id_col, text)
    if found is None:
        rows = rows.withColumn("_rules", F.array().cast("array<int>"))
    else:
        found = bounded_broadcast(materialize(found).withColumnsRenamed({"doc_id": "_id", "_hash": "_h"}))
        rows = rows.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_h")), "left")
    parts = []
    for n, r in enumerate(rules):
        spans = _spans(F.col("text"), r, n)
        parts.append(F.when(F.array_contains("_rules", n), spans).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int>>")) if trigram_query(r.regex) else spans)
    return rows.select("doc_id", "text", F.sort_array(F.concat(*parts)).alias("spans"), *(["row"] if carry else []))


def _of_kind(k: int) -> Column:
    return F.filter("spans", lambda s: s["kind"] == k)


def _joined(spans: Column, kinds: list[str]) -> Column:
    names = F.array(*map(F.lit, kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_scan(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_assign, n_access, n_hex, base_sha256, spans ("kind:start:end", by start).

    Null or empty text: no spans, the digest of the empty string. A null id stays null; repeated rows are scanned
    each; other columns of docs are not read. The first len(BASE) rules are the base kinds.
    """
    n_base = len(BASE)
    out = find_spans(docs, rules, id_col, text_col)
    return out.select(
        "doc_id",
        *(F.size(_of_kind(k)).cast("long").alias(f"n_{r.kind}") for k, r in enumerate(rules[:n_base])),
        F.sha2(_joined(F.filter("spans", lambda s: s["kind"] < n_base), [r.kind for r in rules]), 256).alias("base_sha256"),
        _joined(F.col("spans"), [r.kind for r in rules]).alias("spans"),
    )


def mask_secrets(docs: DataFrame, rules=RULES, mask: str = "[SECRET]", id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """docs with each stretch of overlapping spans of its text replaced by mask, all its columns kept; length_col, if
    given, gets the new length of a masked text. Rows without spans, null texts too, are as they were."""
    found = find_spans(docs, rules, id_col, text_col, carry=True)
    seed = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc, s):
        piece = F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"])
        out = F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.array(piece, F.lit(mask)))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    walked = F.aggregate("spans", seed, step)
    tail = F.substring(F.col("text"), walked["at"] + 1, F.length("text"))
    hit = F.size("spans") > 0
    out = found.withColumn("masked", F.when(hit, F.concat(F.array_join(walked["out"], ""), tail)))
    cols = []
    for c, kind in docs.dtypes:
        old = F.col("row")[c]
        new = F.col("masked") if c == text_col else F.length("masked") if c == length_col else None
        cols.append((old if new is None else F.when(hit, new.cast(kind)).otherwise(old)).alias(c))
    return out.select(*cols)
