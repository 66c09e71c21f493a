"""Benchmark decontamination by template canonicalisation. DataFrame functions only.

Texts become token sequences: words, numbers, units. A number (digits with inner separators, or a number word) turns into
#num, a unit directly after a number into #unit, a capitalised word inside a sentence into #name; other words are
lower-cased. Windows of `window` tokens are hashed and joined with the windows of the benchmark items. A matched window
whose slots (the replaced tokens) are equal is verbatim. Otherwise its slots must be consistent: over the matched windows
of one occurrence of an item, each slot value of the item stands for one value of the document. An item is found in a
document if the matched windows, verbatim or consistent, of its best occurrence (or all of the document's, if consistent
as a whole) cover at least `min_share` of the item's windows.

An item of fewer tokens than `window` has one window of all its tokens, looked for at its own length. Windows of fewer
than `min_literals` literal tokens say too little as templates; an item that has no others (made of numbers and names) is
looked for verbatim, by the raw tokens of its full windows. Only an item that is both shorter than `window` and of fewer
than `min_literals` literal tokens cannot be told from chance and is not looked for.

Edge cases: null or empty texts have no windows; repeated rows are judged alike, each by its id and text; null ids are
kept; items that match equally well are all reported, and of an item's equally good occurrences the first counts; an empty
benchmark finds nothing, an empty table of documents gives no rows; other columns may have any names; a very long text is
one row's array of tokens, and its windows are made one by one as they are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

WINDOW = 8
MIN_LITERALS = 4
MIN_SHARE = 0.4
#: Largest estimated size of the benchmark's windows that is broadcast; beyond it the join shuffles both sides.
BROADCAST_ROWS = 50_000

# Number words and units.
NUMBER_WORDS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
UNITS = "% $ € £ ° mm cm m km mg g kg t ml l s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months year years inch inches foot feet yard yards mile miles ounce ounces pound pounds gallon gallons liter liters litre litres meter meters metre metres gram grams kilogram kilograms dollar dollars euro euros cent cents percent degree degrees mph kmh".split()

_NUMBER = r"[0-9]++(?:[.,:][0-9]++)*+"
_LETTERS = r"[\p{L}\p{M}]+"
_SIGNS = "[%$€£°]"
#: A capitalised word after a word or comma and one space, that is, inside a sentence.
_NAME = r"\p{Lu}(?<=[\p{L}\p{N},;:] .)[\p{L}\p{M}]+"
#: For numbers before a unit: begins at a number's first digit and never gives digits back, so long runs take linear time.
_WHOLE_NUMBER = r"[0-9](?<![0-9].)(?<![0-9][.,:].)[0-9]*+(?:[.,:][0-9]++)*+"
_UNIT = _WHOLE_NUMBER + "( ?)(?:" + "|".join(sorted((u for u in UNITS if u.isalpha()), key=lambda u: (-len(u), u))) + r")(?![\p{L}\p{M}])"
_SIGN_UNIT = _WHOLE_NUMBER + "( ?)" + _SIGNS
#: With the character before it, which a text's first word is given: only non-letters are tried.
_NUMBER_WORD = r"([^\p{L}\p{M}])(?:" + "|".join(NUMBER_WORDS) + r")(?![\p{L}\p{M}])"


def canonical(text: Column) -> Column:
    """The template's tokens. Every replacement leaves one token in the place of one, so they align with raw_tokens.

    Numbers and signs may touch letters ('19th'): a blank after their placeholder keeps the letters a token of their own.
    """
    t = F.concat(F.lit(" "), F.lower(F.regexp_replace(F.translate(text, "#", " "), _NAME, "#name")))
    for pattern, by in ((_UNIT, "#num$1#unit"), (_SIGN_UNIT, "#num$1#unit "), (_NUMBER, "#num "), (_NUMBER_WORD, "$1#num")):
        t = F.regexp_replace(t, pattern, by)
    return F.regexp_extract_all(t, F.lit(f"#[a-z]+|{_LETTERS}|{_SIGNS}"), F.lit(0))


def raw_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"{_NUMBER}|{_LETTERS}|{_SIGNS}"), F.lit(0))


def _pair(i: Column, length: int) -> Column:
    return F.xxhash64(*[F.get("__c", i + j) for j in range(min(length, 2))])


def windows(rows: DataFrame, keys: list[str], lengths: dict[int, list[int] | None], tokens=canonical) -> DataFrame:
    """(keys, h, head, pos): the hash of every window and of its first two tokens.

    lengths: the windows' lengths, each with the heads to which windows are limited (None: all).
    """
    t = rows.select(*keys, tokens(F.coalesce(F.col("__text").cast("string"), F.lit(""))).alias("__c"))
    # Element access is constant-time; slice() would copy the whole array for every window. No filter on the array here:
    # pushed down, it would evaluate the tokens inside lambdas, once an element.

    def of_length(n: int, heads: list[int] | None) -> Column:
        starts = F.when(F.size("__c") >= n, F.sequence(F.lit(0), F.size("__c") - n))
        if heads is not None:
            starts = F.filter(starts, lambda i: _pair(i, n).isin(heads))
        return F.transform(starts, lambda i: F.struct(F.xxhash64(*[F.get("__c", i + j) for j in range(n)]).alias("h"), _pair(i, n).alias("head"), i.alias("pos")))

    found = [t.select(*keys, F.explode(of_length(n, heads)).alias("w")).select(*keys, "w.*", F.lit(n).alias("length")) for n, heads in sorted(lengths.items())]
    out = found[0]
    for other in found[1:]:
        out = out.unionByName(other)
    return out


def item_windows(benchmark: DataFrame, window: int, min_literals: int) -> DataFrame:
    """(item_id, h, head, item_pos, length, slots, verbatim): slots: (j, value) of a window's replaced tokens, null if there
    are none. verbatim: hashed by raw tokens, for items without a window of enough literal tokens."""
    rows = benchmark.select("item_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select("item_id", canonical(F.col("text")).alias("c"), raw_tokens(F.col("text")).alias("r"))
    length = F.least(F.lit(window), F.size("c"))
    cut = rows.select("*", length.alias("length"), F.explode(F.when(F.size("c") > 0, F.sequence(F.lit(0), F.size("c") - length))).alias("item_pos"))
    token = lambda a, j: F.when(j < F.col("length"), F.get(a, F.col("item_pos") + j))
    at = F.filter(F.sequence(F.lit(0), F.col("length") - 1), lambda j: token("c", j).startswith("#"))
    slots = F.transform(at, lambda j: F.struct(j.alias("j"), token("r", j).alias("v")))
    hashes = [x for a in "cr" for x in (F.xxhash64(*[token(a, F.lit(j)) for j in range(window)]).alias(f"{a}_h"), F.xxhash64(token(a, F.lit(0)), token(a, F.lit(1))).alias(f"{a}_head"))]
    made = cut.select("item_id", "item_pos", "length", F.when(F.size(slots) > 0, slots).alias("slots"), *hashes)
    made = made.withColumn("literal", F.col("length") - F.coalesce(F.size("slots"), F.lit(0)) >= min_literals)
    made = made.withColumn("any_literal", F.max("literal").over(Window.partitionBy("item_id")))
    made = made.where(F.col("literal") | ~F.col("any_literal") & (F.col("length") == window))
    pick = lambda x: F.when(F.col("literal"), F.col(f"c_{x}")).otherwise(F.col(f"r_{x}")).alias(x)
    return made.select("item_id", pick("h"), pick("head"), "item_pos", "length", F.when(F.col("literal"), F.col("slots")).alias("slots"), (~F.col("literal")).alias("verbatim")).distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_share: float = MIN_SHARE, min_literals: int = MIN_LITERALS, id_col: str = "doc_id") -> DataFrame:
    """(id, text_key, item_id, item_windows, matched_windows, verbatim_windows, n_slots): an item found in a document."""
    items = materialize(item_windows(benchmark, window, min_literals))
    totals = items.groupBy("item_id").agg(F.countDistinct("item_pos").alias("item_windows"))
    kinds = [(r["verbatim"], r["length"]) for r in items.select("verbatim", "length").distinct().collect()]  # one length each, `window` at most
    small = items.count() <= BROADCAST_ROWS
    key = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    own = docs.select(F.col(id_col).alias("__id"), key.alias("__key"), F.col("text").alias("__text"))
    hits = None
    for verbatim, tokens in ((False, canonical), (True, raw_tokens)):
        lengths = {n: None for v, n in kinds if v == verbatim}
        if not lengths and (verbatim or hits is not None or kinds):
            continue
        mine = items.where(F.col("verbatim") == verbatim)
        if small:
            # Bounded: the windows' first pairs go along as a set, so that few windows of documents are built and joined.
            lengths = {n: [r[0] for r in mine.where(F.col("length") == n).select("head").distinct().collect()] for n in lengths}
            mine = F.broadcast(mine)
        found = windows(own, ["__id", "__key"], lengths or {window: []}, tokens).join(mine.drop("head", "verbatim"), ["h", "length"])
        found = found.select("__id", "__key", "item_id", "item_pos", "pos", F.col("slots").alias("item_slots"))
        hits = found if hits is None else hits.unionByName(found)
    hits = hits.distinct()
    hits = materialize(hits)
    # Slot values are fetched for windows that have slots only.
    slotted = hits.where(F.col("item_slots").isNotNull())
    raw = own.withColumnsRenamed({"__id": "__i", "__key": "__k"}).join(slotted.select(F.col("__id").alias("__x"), F.col("__key").alias("__y")).distinct(), F.col("__i").eqNullSafe(F.col("__x")) & (F.col("__k") == F.col("__y")), "left_semi").select("__i", "__k", raw_tokens(F.col("__text")).alias("__r"))
    valued = slotted.join(raw, F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__key") == F.col("__k"))).select("__id", "__key", "item_id", "item_pos", "pos", F.transform("item_slots", lambda s: F.struct(s["v"].alias("a"), F.get("__r", F.col("pos") + s["j"]).alias("b"))).alias("pairs"))
    valued = valued.distinct().select("*", F.forall("pairs", lambda p: F.coalesce(p["a"] == p["b"], F.lit(False))).alias("verbatim"))
    group = ["__id", "__key", "item_id"]
    plain = hits.where(F.col("item_slots").isNull())
    judged = plain.select(*group, "item_pos", "pos", F.lit(None).cast(valued.schema["pairs"].dataType).alias("pairs"), F.lit(True).alias("verbatim")).unionByName(valued)
    # An item may occur several times in a document, with other values each: windows of one occurrence lie at about the
    # same offset. Consistency is judged for the whole document, for runs of near offsets and for each offset.
    offset = F.col("pos") - F.col("item_pos")
    by_offset = Window.partitionBy(*group).orderBy("offset")
    judged = judged.select("*", offset.alias("offset"))
    judged = judged.select("*", F.when(F.col("offset") - F.lag("offset").over(by_offset) < window, 0).otherwise(1).alias("new"))
    judged = judged.select("*", F.sum("new").over(by_offset).cast("int").alias("run"))
    places = F.array(*[F.struct(F.lit(i).alias("level"), c.cast("int").alias("at")) for i, c in enumerate((F.lit(0), F.col("run"), F.col("offset")))])
    placed = judged.select(*group, "item_pos", "pairs", "verbatim", F.explode(places).alias("place"))
    here = [*group, "place"]
    slots = placed.where(~F.col("verbatim")).select(*here, F.explode("pairs").alias("s")).groupBy(*here).agg(F.countDistinct("s.a").alias("n_slots"), F.countDistinct("s").alias("n_pairs"))
    counts = placed.groupBy(*here).agg(F.countDistinct("item_pos").alias("all_windows"), F.countDistinct(F.when(F.col("verbatim"), F.col("item_pos"))).alias("verbatim_windows"))
    same = [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in here]
    merged = counts.alias("x").join(slots.alias("y"), same[0] & same[1] & same[2] & same[3], "left").select("x.*", F.coalesce("y.n_slots", F.lit(0)).alias("n_slots"), F.coalesce("y.n_pairs", F.lit(0)).alias("n_pairs"))
    merged = merged.withColumn("matched_windows", F.when(F.col("n_pairs") == F.col("n_slots"), F.col("all_windows")).otherwise(F.col("verbatim_windows")))
    # The best place; verbatim windows are counted in the whole document, as the place of level 0 does.
    best = F.max(F.struct("matched_windows", (-F.col("place.level")).alias("l"), (-F.col("place.at")).alias("a"), "n_slots")).alias("best")
    merged = merged.groupBy(*group).agg(best, F.max("verbatim_windows").alias("verbatim_windows")).select(*group, "best.matched_windows", "verbatim_windows", "best.n_slots")
    found = merged.join(totals, "item_id").where(F.col("matched_windows") >= min_share * F.col("item_windows"))
    return found.select(F.col("__id").alias(id_col), F.col("__key").alias("text_key"), "item_id", "item_windows", "matched_windows", "verbatim_windows", F.col("n_slots").cast("long").alias("n_slots"))


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Stage form: documents in which no item is found, all columns as they came."""
    found = contaminated(docs, benchmark).select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct()
    key = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("own_id"), key.alias("own_key"))
    kept = rows.join(found, F.col("own_id").eqNullSafe(F.col("__id")) & (F.col("own_key") == F.col("__key")), "left_anti")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
