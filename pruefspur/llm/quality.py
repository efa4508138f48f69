"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger keeps what was measured and one bit per
failed rule; a policy is a version of which bits count.  A new policy, or the question what a rule
alone removes, is then arithmetic on the ledger and reads no text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import WORD, once, packed

WINDOW = 8
SYMBOLS = "#*$%&|<>"

MEASURES = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_letters n_upper n_alpha_words"
).split()


@dataclass(frozen=True)
class Rule:
    """A document fails where ``fails`` holds.  All rules compare whole numbers, so that no result
    hangs on the rounding of a quotient."""

    name: str
    fails: Column


def rules() -> list[Rule]:
    """The rules; the position is the bit.  New rules go at the end, so that old ledgers stay
    readable."""
    c = F.col
    return [
        Rule("few_words", c("n_words") < 20),
        Rule("repeated_windows", 100 * c("n_repeat_words") > 30 * c("n_words")),
        Rule("symbols", 100 * c("n_symbols") > 10 * c("n_words")),
        Rule("repeated_lines", 100 * c("n_dup_lines") > 30 * c("n_lines")),
        Rule("short_words", c("word_chars") < 3 * c("n_words")),
        Rule("long_words", c("word_chars") > 12 * c("n_words")),
        Rule("no_letters_in_words", 100 * c("n_alpha_words") < 70 * c("n_words")),
        Rule("capitals", 100 * c("n_upper") > 40 * c("n_letters")),
    ]


#: Policies by version: the rules that count.  A version is never changed.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": ("few_words", "repeated_windows"),
    "v2": (
        "few_words",
        "repeated_windows",
        "symbols",
        "repeated_lines",
        "short_words",
        "long_words",
        "no_letters_in_words",
        "capitals",
    ),
}
BASE, CURRENT = "v1", "v2"


def mask(version: str) -> int:
    bits = {r.name: i for i, r in enumerate(rules())}
    return sum(1 << bits[n] for n in POLICIES[version])


def _measured(df: DataFrame) -> DataFrame:
    """Measurements of ``_text``; keeps ``_in``."""
    text = F.coalesce("_text", F.lit(""))
    df = once(df.withColumn("_text", text), _words=F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)))
    df = once(df, _hashes=F.transform("_words", lambda w: F.xxhash64(w)))
    n = F.size("_hashes")
    window = lambda i: F.xxhash64(*[F.get("_hashes", i + k) for k in range(WINDOW)])
    none = F.array().cast("array<bigint>")
    df = once(
        df,
        _windows=F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), window)).otherwise(none),
    )
    # Few documents repeat a window; only those sort their windows.
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    places = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = once(
        df, _sorted=F.when(repeats, places).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    )

    def repeated(x: Column, k: Column) -> Column:
        same = lambda j: F.coalesce(F.get("_sorted", j)["h"] == x["h"], F.lit(False))
        return F.when(same(k - 1) | same(k + 1), x["i"])

    df = once(
        df,
        _starts=F.sort_array(F.filter(F.transform("_sorted", repeated), lambda i: i.isNotNull())),
        _lines=F.filter(F.split("_text", "\n"), lambda x: x.rlike(WORD)),
    )
    # A window covers its words up to the next repeated window's start.
    covered = F.aggregate(
        F.transform(
            "_starts",
            lambda s, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_starts", k + 1) - s, F.lit(WINDOW))),
        ),
        F.lit(0).cast("bigint"),
        lambda a, x: a + x,
    )
    kept_only = lambda chars: F.length(F.regexp_replace("_text", f"[^{chars}]+", ""))
    alpha = r"[^\x20\x09-\x0D\p{L}]*+\p{L}[^\x20\x09-\x0D]*+"
    return df.select(
        "_in",
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.regexp_replace("_text", r"[\x20\x09-\x0D]+", "")).cast("bigint").alias("word_chars"),
        kept_only(SYMBOLS).cast("bigint").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        kept_only(r"\p{L}").cast("bigint").alias("n_letters"),
        kept_only(r"\p{Lu}").cast("bigint").alias("n_upper"),
        F.regexp_count("_text", F.lit(alpha)).cast("bigint").alias("n_alpha_words"),
    )


def _with_failures(df: DataFrame) -> DataFrame:
    bits = [
        F.when(r.fails, F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, r in enumerate(rules())
    ]
    return df.withColumn("failures", reduce(lambda a, b: a.bitwiseOR(b), bits))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, the measurements, and ``failures``, a bit per failed rule.

    A null text is an empty one: no words, so it fails ``few_words``.  Rows are judged each for
    itself, so repeated rows get equal entries, and a null id stays null.  Other input columns are
    not read.  An empty table gives an empty ledger.
    """
    work = docs.select(F.struct(F.col(id_col).alias("id")).alias("_in"), F.col(text_col).alias("_text"))
    return _with_failures(_measured(work)).select(
        F.col("_in.id").alias(id_col), *MEASURES, "failures"
    )


def passes(version: str) -> Column:
    """Whether a ledger row passes a policy."""
    return F.col("failures").bitwiseAND(F.lit(mask(version)).cast("bigint")) == 0


def filtered(docs: DataFrame, version: str = CURRENT, text_col: str = "text") -> DataFrame:
    """The documents that pass a policy, with all their columns, in one pass without a shuffle."""
    work = _with_failures(_measured(packed(docs, _text=F.col(text_col))))
    return work.filter(passes(version)).select("_in.*")


def ablation(entries: DataFrame, version: str = CURRENT) -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone (and would come back without
    it), and that fail together with others.  One aggregate over the ledger's bits."""
    counted = F.lit(mask(version)).cast("bigint")
    hit = F.col("failures").bitwiseAND(counted)
    names = [(i, r.name) for i, r in enumerate(rules()) if mask(version) >> i & 1]
    sums = entries.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.shiftright(hit, i).bitwiseAND(F.lit(1).cast("bigint"))).alias(f"f{i}") for i, _ in names],
        *[F.sum((hit == (1 << i)).cast("bigint")).alias(f"a{i}") for i, _ in names],
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("bigint"))
    rows = [
        F.struct(
            F.lit(version).alias("policy"),
            F.lit(name).alias("rule"),
            F.col("n").alias("n_docs"),
            zero(f"f{i}").alias("n_failed"),
            zero(f"a{i}").alias("n_failed_alone"),
        )
        for i, name in names
    ]
    return sums.select(F.inline(F.array(*rows)))
