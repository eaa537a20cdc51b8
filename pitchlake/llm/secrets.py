"""Secret scan in column expressions: base patterns, and windows of high character entropy.

All spans of a text stay in arrays of its row, so the scan neither shuffles nor calls Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the base rules. Letters are spelled in both cases, ASCII only.
ASSIGN = (
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
    r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
#: Shorter runs fail the rule and can't hold a longer match, so they aren't matched at all.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
ASSIGN_VALUE = 6

#: Candidate strings of the entropy rule: runs of key-like characters with a digit.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: Least bits per character of a window, by its character class. Hexadecimal digits reach
#: log2(16) = 4 at most and a window of 20 log2(20) = 4.32; words and numbers stay below these.
HEX_BITS, ALNUM_BITS, MIXED_BITS = 3.0, 3.7, 3.6
#: Candidates that are known to be harmless as a whole: identifiers of fixed form, paths, runs.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^(/[a-z0-9_-]*)+$",
    r"^[0-9_+/=-]+$",
    r"^[A-Za-z]+([-_/][A-Za-z]+)*[-_/]?[0-9]{1,4}$",
)

#: A window that holds one of these is harmless; others of the same candidate need not be.
PLACEHOLDER = r"(?i)example|placeholder|changeme|dummy|xxxx|0000|1234|abcd"

#: What takes the place of a secret.
MARK = "[SECRET]"

KINDS = ("assign", "access", "hex", "entropy")
_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _matches(text: Column, pattern: str, kind: int) -> Column:
    """(start, kind, end, match) of every leftmost, non-overlapping match, in code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    # The i-th match starts after i + 1 texts between matches and i matches.
    lengths = F.transform(
        found, lambda m, i: F.struct(
            F.length(F.get(between, i)).alias("gap"), F.length(m).alias("n"), m.alias("m")))
    empty = F.array().cast("array<struct<start:int,kind:int,end:int,match:string>>")
    state = F.struct(F.lit(0).alias("at"), empty.alias("spans"))
    return F.when(F.size(found) > 0, F.aggregate(
        lengths, state,
        lambda s, x: F.struct(
            (s["at"] + x["gap"] + x["n"]).alias("at"),
            F.concat(s["spans"], F.array(F.struct(
                (s["at"] + x["gap"]).alias("start"), F.lit(kind).alias("kind"),
                (s["at"] + x["gap"] + x["n"]).alias("end"), x["m"].alias("match"),
            ))).alias("spans")),
        lambda s: s["spans"],
    )).otherwise(empty)


def _without_text(spans: Column) -> Column:
    return F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"),
                                  s["end"].alias("end")))


def _term(n: Column) -> Column:
    """n log2 n, the share of a character seen n times in the entropy of a window."""
    return F.when(n > 1, n * F.log2(n)).otherwise(F.lit(0.0))


def _hot_windows(candidate: Column) -> Column:
    """Spans of one candidate whose windows pass the limit of their class, merged.

    One fold over the characters: the character that enters and the one that leaves change two
    counts, and with them the sum of n log2 n and the class counts; nothing is counted anew.
    """
    text, base = candidate["match"], candidate["start"]
    codes = F.transform(F.split(text, ""), lambda c: F.ascii(c) - 43)  # '+' to 'z' is 0 to 79
    slots = F.array_repeat(F.lit(0), 80)

    def kinds(code: Column) -> list[Column]:
        char = code + 43
        digit = char.between(48, 57)
        small = char.between(97, 102)
        return [
            (~digit & ~small).cast("int"),  # not hexadecimal
            digit.cast("int"),
            char.between(65, 90).cast("int"),
            char.between(97, 122).cast("int"),
        ]

    names = ("other", "digits", "upper", "lower")
    state = F.struct(
        slots.alias("counts"), F.lit(0.0).alias("terms"),
        *[F.lit(0).alias(n) for n in names],
        F.array().cast(_SPAN).alias("spans"))

    def step(s: Column, i: Column) -> Column:
        new, old = F.get(codes, i), F.get(codes, i - WINDOW)
        leaves = i >= WINDOW
        added = F.get(s["counts"], new)
        one = F.transform(s["counts"], lambda c, k: c + (k == new).cast("int"))
        gone = F.get(one, old)
        counts = F.when(
            leaves, F.transform(one, lambda c, k: c - (k == old).cast("int"))).otherwise(one)
        terms = s["terms"] + _term(added + 1) - _term(added) + F.when(
            leaves, _term(gone - 1) - _term(gone)).otherwise(F.lit(0.0))
        now = {
            n: s[n] + x - F.when(leaves, y).otherwise(F.lit(0))
            for n, x, y in zip(names, kinds(new), kinds(old), strict=True)}
        bits = F.log2(F.lit(float(WINDOW))) - terms / WINDOW
        limit = (
            F.when((now["other"] == 0) & (now["digits"] < WINDOW), F.lit(HEX_BITS))
            .when((now["upper"] > 0) & (now["lower"] > 0), F.lit(MIXED_BITS))
            .otherwise(F.lit(ALNUM_BITS)))
        hot = (i >= WINDOW - 1) & (now["digits"] > 0) & (
            now["digits"] < WINDOW) & (bits >= limit - 1e-9) & ~F.substring(
            text, i - WINDOW + 2, F.lit(WINDOW)).rlike(PLACEHOLDER)
        start, end = base + i - WINDOW + 1, base + i + 1
        last = F.try_element_at(s["spans"], F.lit(-1))
        spans = (
            F.when(~hot, s["spans"])
            .when((F.size(s["spans"]) > 0) & (start <= last["end"]), F.concat(
                F.slice(s["spans"], 1, F.size(s["spans"]) - 1),
                F.array(F.struct(last["start"].alias("start"), last["kind"].alias("kind"),
                                 end.alias("end")))))
            .otherwise(F.concat(s["spans"], F.array(F.struct(
                start.alias("start"), F.lit(3).alias("kind"), end.alias("end"))))))
        return F.struct(
            counts.alias("counts"), terms.alias("terms"), *[now[n].alias(n) for n in names],
            spans.alias("spans"))

    return F.aggregate(
        F.sequence(F.lit(0), F.length(text) - 1), state, step, lambda s: s["spans"])


def secret_spans(text: Column) -> tuple[Column, Column]:
    """(base spans, entropy spans) of a text as arrays of (start, kind, end)."""
    text = F.coalesce(text, F.lit(""))
    assign = F.filter(
        _matches(text, ASSIGN, 0),
        lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= ASSIGN_VALUE)
    base = F.array_sort(F.concat(
        _without_text(assign), _without_text(_matches(text, ACCESS, 1)),
        _without_text(_matches(text, HEX, 2))))
    return base, F.filter(
        _matches(text, CANDIDATE, 3), lambda s: s["match"].rlike("[0-9]"))


def _uncovered(span: Column, base: Column) -> Column:
    """What is left of a span outside of the base spans, which are in order of their starts."""
    def piece(start: Column, end: Column) -> Column:
        return F.array(F.struct(
            start.alias("start"), F.lit(3).alias("kind"), end.alias("end"))).cast(_SPAN)

    none = F.array().cast(_SPAN)
    state = F.struct(span["start"].alias("at"), none.alias("pieces"))
    return F.aggregate(
        F.filter(base, lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"])), state,
        lambda s, b: F.struct(
            F.greatest(s["at"], b["end"]).alias("at"),
            F.concat(s["pieces"], F.when(
                b["start"] > s["at"], piece(s["at"], b["start"])).otherwise(none)).alias("pieces")),
        lambda s: F.concat(s["pieces"], F.when(
            s["at"] < span["end"], piece(s["at"], span["end"])).otherwise(none)))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``__base`` and ``__entropy``: arrays of (start, kind, end) in code points.

    Base spans are whole matches of the three patterns. An entropy span is the union of overlapping
    windows of ``WINDOW`` characters of one candidate that have at least the entropy set for their
    class and hold no placeholder, without what base spans cover of it: the rest of a key beside a
    base span stays. Candidates that are harmless as a whole have none. NULL and empty texts have no
    spans. Each row is scanned by itself, repeated or not; other columns stay as they are.
    """
    base, candidates = secret_spans(F.col(text))
    allowed = "|".join(f"(?:{p})" for p in ALLOWED)
    step = docs.withColumn("__base", base).withColumn("__candidates", candidates)
    free = F.filter("__candidates", lambda s: ~s["match"].rlike(allowed))
    entropy = F.when(F.size("__candidates") > 0, F.flatten(F.transform(
        F.flatten(F.transform(free, _hot_windows)), lambda s: _uncovered(s, F.col("__base")))),
    ).otherwise(F.array().cast(_SPAN))
    return step.withColumn("__entropy", entropy).drop("__candidates")


def _joined(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``scan``."""
    def count(kind: int) -> Column:
        return F.size(F.filter("__base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_joined(F.col("__base")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("__base", "__entropy"))).alias("spans"))


def redact(docs: DataFrame, text: str = "text", mark: str = MARK) -> DataFrame:
    """``docs`` with every span replaced by ``mark``; overlapping spans give one mark.

    Spans are those of ``scan``; spans that meet give one mark each. Rows, other columns and texts
    without spans stay as they are.
    """
    columns = docs.columns
    found = scan(docs, text)
    spans = F.array_sort(F.concat("__base", "__entropy"))
    # The text up to each span that starts behind all earlier ones, then the rest.
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    cut = F.aggregate(
        spans, state,
        lambda s, x: F.struct(
            F.greatest(s["at"], x["end"]).alias("at"),
            F.when(x["start"] >= s["at"], F.concat(
                s["out"], F.substring(F.col(text), s["at"] + 1, x["start"] - s["at"]), F.lit(mark))
            ).otherwise(s["out"]).alias("out")),
        lambda s: F.concat(s["out"], F.substring(
            F.col(text), s["at"] + 1, F.length(F.col(text)))))
    return found.withColumn(
        text, F.when(F.size(spans) > 0, cut).otherwise(F.col(text))).select(*columns)
