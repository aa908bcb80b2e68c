"""Secret scans: fixed formats and sliding-window entropy.

Base kinds are regular expressions. The method adds ``entropy`` spans: over
each candidate run of token characters a window of 20 characters slides, with
the counts per character (and the sum of c*log2(c)) updated by the character
that enters and the one that leaves; the run is a secret when some window's
Shannon entropy passes the threshold of the run's character class. Runs on
the allow list, and runs inside a base span, are left out.

Start and end are code points, found from the lengths of the pieces between
the matches, so everything is one projection: no shuffle, one row at a time.

Results at the edges: a null text counts as empty and has no spans; texts of
any length are scanned whole; repeated rows are scanned one by one; an empty
table gives an empty table; a column of the input named ``spans`` is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import let

#: The base formats, in the order of kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "entropy")
VALUE_MIN = 12

WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Character classes of a run (first that fits) and the entropy in bits a window must pass.
CLASSES = ((r"^[0-9a-fA-F]+$", 3.05), (r"^[0-9a-zA-Z]+$", 3.65), (r"^[A-Za-z0-9+/_=-]+$", 3.85))
#: Runs that are never secrets: no digits, only digits, no letter case change in words with numbers, UUIDs.
ALLOWED = (
    r"^[A-Za-z+/_=-]+$",
    r"^[0-9+/_=-]+$",
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^([A-Za-z]+|[0-9]{1,4})([/_=-]+([A-Za-z]+|[0-9]{1,4}))*[/_=-]*$",
)

SPAN = "array<struct<s:int,k:int,e:int>>"


def _spans(text: Column, pattern: str, kind: int, check: str | None = None) -> Column:
    """Leftmost, non-overlapping matches as (start, kind, end)."""
    none = F.array().cast(SPAN)

    def walk(gaps: Column, found: Column, value: Column) -> Column:
        zipped = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)).alias("g"), found.alias("m"), value.alias("v"))
        zero = F.struct(F.lit(0).alias("at"), none.alias("out"))

        def step(a: Column, x: Column) -> Column:
            start = a["at"] + F.char_length(x["g"])
            end = start + F.char_length(x["m"])
            span = F.struct(start.alias("s"), F.lit(kind).alias("k"), end.alias("e"))
            keep = F.char_length(x["v"]) >= VALUE_MIN if check else F.lit(True)
            return F.struct(end.alias("at"), F.when(keep, F.array_append(a["out"], span)).otherwise(a["out"]).alias("out"))

        return F.aggregate(zipped, zero, step, lambda a: a["out"])

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if check else found
    return F.when(F.regexp_like(text, F.lit(pattern)), walk(F.split(text, pattern, -1), found, value)).otherwise(none)


def max_window_entropy(run: Column, width: int = WINDOW) -> Column:
    """Largest Shannon entropy (bits per character) of a window of the run."""
    codes = F.transform(F.split(run, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    weight = lambda n: F.when(n > 1, n * F.log2(n.cast("double"))).otherwise(0.0)

    def slide(a: Column) -> Column:
        zero = F.struct(
            F.array_repeat(F.lit(0), len(ALPHABET) + 1).alias("n"), F.lit(0.0).alias("w"), F.lit(0.0).alias("best")
        )

        def step(s: Column, i: Column) -> Column:
            into = F.get(a, i)
            out = F.when(i >= width, F.get(a, i - width)).otherwise(F.lit(-1))
            n_in = F.get(s["n"], into)
            w1 = s["w"] + weight(n_in + 1) - weight(n_in)
            # the character that leaves, counted with the one that entered
            n_out = F.get(s["n"], out) + F.when(out == into, 1).otherwise(0)
            w2 = w1 + F.when(out >= 0, weight(n_out - 1) - weight(n_out)).otherwise(0.0)
            counts = F.transform(
                s["n"], lambda c, k: c + F.when(k == into, 1).otherwise(0) - F.when(k == out, 1).otherwise(0)
            )
            full = F.lit(float(width))
            bits = F.when(i >= width - 1, F.log2(full) - w2 / full).otherwise(0.0)
            return F.struct(counts.alias("n"), w2.alias("w"), F.greatest(s["best"], bits).alias("best"))

        return F.aggregate(F.sequence(F.lit(0), F.size(a) - 1), zero, step, lambda s: s["best"])

    return let(codes, slide)


def _secret_like(run: Column) -> Column:
    allowed = F.lit(False)
    for p in ALLOWED:
        allowed = allowed | F.regexp_like(run, F.lit(p))
    bound = F.lit(99.0)
    for p, bits in reversed(CLASSES):
        bound = F.when(F.regexp_like(run, F.lit(p)), bits).otherwise(bound)
    return F.when(allowed, False).otherwise(max_window_entropy(run) > bound)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``spans``: array of (s, k, e) by start, then kind, then end.

    ``s`` and ``e`` are code points (end exclusive), ``k`` indexes ``KINDS``.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    base = F.concat(_spans(t, ASSIGN, 0, "value"), _spans(t, ACCESS, 1), _spans(t, HEX, 2))
    d = docs.drop("spans").withColumns({"_t": t, "_base": F.sort_array(base)})

    def extra(runs: Column) -> Column:
        outside = lambda x: ~F.exists("_base", lambda b: (b["s"] <= x["s"]) & (b["e"] >= x["e"]))
        piece = lambda x: F.substring(F.col("_t"), x["s"] + 1, x["e"] - x["s"])
        return F.filter(runs, lambda x: outside(x) & _secret_like(piece(x)))

    runs = _spans(F.col("_t"), CANDIDATE, 3)
    d = d.withColumn("spans", F.sort_array(F.concat(F.col("_base"), let(runs, extra))))
    return d.drop("_t", "_base")


def spans_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    name = lambda x: F.get(F.array(*map(F.lit, KINDS)), x["k"])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", name(x), x["s"], x["e"])), ",")


def of_kind(spans: Column, *kinds: int) -> Column:
    return F.filter(spans, lambda x: x["k"].isin(*kinds))
