"""Quality rules: every rule is evaluated once into a ledger of measurements and failure bits; policies are bit masks.

`ledger` gives a row a document: the measurements and `failure_bits`, bit i set where rule i fails. A policy is a named,
versioned mask of the rules that reject; applying one, comparing versions, or asking what each rule alone decides
(`ablation`) are bit operations on the ledger, whose counts are first summed by bit pattern. DataFrame functions only.

Edge cases: null or empty text has no words and fails `few_words`; a document of under three words has no 3-word window;
repeated rows are judged each by itself; an empty table gives an empty ledger; null ids stay null; bounds are strict, so a
measurement that equals one passes; columns of the input besides id and text never enter the ledger, whatever their names;
a very long text is measured whole, its words an array in memory.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """Fails where the SQL condition over the measurements holds. All measurements are whole numbers: no rounding."""

    name: str
    fails: str


#: Order gives the bit; append only, so that stored bits keep their meaning.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("short_words", "10 * word_chars < 20 * n_words"),
    Rule("long_words", "10 * word_chars > 200 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 30 * n_lines AND n_dup_lines >= 3"),
    Rule("exclamations", "10 * n_exclamations > 3 * n_words AND n_words > 0"),
)
BIT = {r.name: 1 << i for i, r in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...] = field(default_factory=tuple)

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
POLICIES = {p.name + str(p.version): p for p in (BASE, Policy("web", 1, tuple(r.name for r in RULES if r.name != "exclamations")), Policy("web", 2, tuple(r.name for r in RULES)))}
DEFAULT_POLICY = POLICIES["web2"]


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_exclamations, failure_bits)."""
    text, words, lines, windows = F.col("__t"), F.col("__w"), F.col("__l"), F.col("__s")
    long = lambda c: c.cast("long")
    bare = text
    for c in " \t\n\x0b\x0c\r":
        bare = F.replace(bare, F.lit(c), F.lit(""))
    base = docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__t"))
    base = base.select("*", F.filter(F.split(text, SPACE), lambda w: w != "").alias("__w"), F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("__l"))
    window = F.transform(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.struct(F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")),
    )
    # Twice-hashed windows lie side by side once sorted.
    base = base.select("*", F.sort_array(window).alias("__s"))
    same = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
    twice = F.filter(windows, lambda x, i: same(F.get(windows, i - 1), x) | same(F.get(windows, i + 1), x))
    covered = F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    measured = base.select(
        F.col(id_col),
        long(F.size(words)).alias("n_words"),
        long(F.char_length(bare)).alias("word_chars"),
        long(F.regexp_count(text, F.lit(SYMBOLS))).alias("n_symbols"),
        long(F.size(lines)).alias("n_lines"),
        long(F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
        long(F.size(covered)).alias("n_repeat_words"),
        long(F.char_length(text) - F.char_length(F.replace(text, F.lit("!"), F.lit("")))).alias("n_exclamations"),
    )
    bits = F.lit(0).cast("long")
    for r in RULES:
        bits = bits + F.when(F.expr(r.fails), F.lit(BIT[r.name])).otherwise(F.lit(0)).cast("long")
    # The condition always holds. It keeps filters on the bits from being pushed below, where every measurement would be
    # evaluated again, and inside lambdas once an element.
    return measured.select("*", F.when(F.monotonically_increasing_id() >= 0, bits).alias("failure_bits"))


def keeps(policy: Policy, bits: Column | str = "failure_bits") -> Column:
    return (F.col(bits) if isinstance(bits, str) else bits).bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def apply_policies(led: DataFrame, policies: dict[str, Policy]) -> DataFrame:
    """The ledger with a verdict column `kept_<policy>` for each policy."""
    return led.select("*", *[keeps(p).alias(f"kept_{k}") for k, p in policies.items()])


def ablation(led: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of a policy: documents that fail it, those only it rejects, and those kept if it were dropped.

    The ledger is counted by bit pattern first (at most 2**rules rows), so the bit operations run on a handful of rows.
    """
    counts = led.groupBy("failure_bits").agg(F.count("*").alias("n"))
    spark = led.sparkSession
    rules = spark.createDataFrame([(r, BIT[r], policy.mask) for r in policy.rules], "rule string, bit long, mask long")
    hit = F.col("failure_bits").bitwiseAND(F.col("mask"))
    count = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("long")
    joined = rules.join(counts, F.lit(True), "left")  # rules times bit patterns, both bounded by the rule list
    return joined.groupBy("rule", "bit").agg(
        count(F.col("failure_bits").bitwiseAND(F.col("bit")) != 0).alias("fails"),
        count(hit == F.col("bit")).alias("only_this"),
        count(hit == 0).alias("kept"),
        count(hit.bitwiseAND(F.bitwise_not(F.col("bit"))) == 0).alias("kept_without"),
    )


def judge(docs: DataFrame, policy: Policy = DEFAULT_POLICY, id_col: str = "doc_id") -> DataFrame:
    """The ledger with base_failed (the base policy rejects) and kept (neither it nor the given policy rejects)."""
    return ledger(docs, id_col).select("*", (~keeps(BASE)).alias("base_failed"), (keeps(BASE) & keeps(policy)).alias("kept"))


def keep_documents(docs: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """The rows whose text passes, all columns as they came. The verdict is computed beside each row: no join."""
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col("text"))
    judged = ledger(held, "__row").where(keeps(BASE) & keeps(policy))
    return judged.select(*[F.col("__row").getField(c).alias(c) for c in docs.columns])


COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")

ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
win AS (SELECT r, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT r, count(DISTINCT i + o) AS c FROM dup, (VALUES (0), (1), (2)) AS v(o) GROUP BY r),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
        (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c, 0)::BIGINT AS n_repeat_words,
        length(regexp_replace(t, '[^!]', '', 'g'))::BIGINT AS x FROM w LEFT JOIN cov USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > 3 * n_words OR 10 * word_chars < 20 * n_words
    OR 10 * word_chars > 200 * n_words OR (100 * n_dup_lines > 30 * n_lines AND n_dup_lines >= 3) OR 10 * x > 3 * n_words) AS kept
FROM m
"""
