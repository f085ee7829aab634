"""Filter interaction audit: every order of the filters folded over the mask cells.

1. A document's failures are a bit mask, one bit for each filter. Filters on the
   text itself are expressions; the duplicate filter compares each text's hash
   with the smallest id that holds it. Equal rows are counted before anything is joined, so
   a group of copies is one counted row for each source and label.
2. Documents become cells: (part, mask) with the weights n, good and toxic.
3. Each cell folds its mask across the array of all orders (a literal of 120 strings):
   ``transform`` over the orders, ``aggregate`` over an order's letters. The outcome is
   one struct for each order and step, 600 for five filters, weighted with the cell.
4. The arrays of a part are summed element by element: position by position, by a
   grouped sum that tasks begin on their own cells.

Columns of the audit, for the filter at a step of an order: ``kept`` documents pass it
and all before it; ``removed`` fail it and none before it; ``redundant`` fail it and one before it;
``unique_fails`` fail it only; ``good_lost`` / ``toxic_lost`` are removed ones with
the label; ``shapley`` sums ``removed`` of the filter over all orders.

Defined results: a null text is empty: it has too few words and may be a duplicate,
nothing else. A null source is the part ''. A document without a label, or with a null
one, is neither good nor toxic; of repeated labels one suffices. Rows that repeat an id
are documents of their own, and none is smaller than the other. A null id is smaller than
none and none is smaller than it, so it never is a duplicate. Very long texts are split into
an array of words inside one row; nothing of a text but its hash and mask is shuffled.
An empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_RUN, UPPER, text_of

MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_UPPER_PERCENT = 200, 50, 2
MARKS = "[#$%&*|]"
DUPLICATE = "E"


def text_filters(text: Column) -> dict[str, Column]:
    """Letter -> failure condition of the filters that need one text only."""
    words = F.array_remove(F.split(text, SPACE_RUN), "")
    upper = F.length(text) - F.length(F.translate(text, UPPER, ""))
    return {
        "A": F.size(words) < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * F.size(words),
        "C": 100 * upper > MAX_UPPER_PERCENT * F.length(text),
        "D": text.rlike(MARKS),
    }


def _bits(letters: str) -> dict[str, int]:
    return {x: 1 << i for i, x in enumerate(letters)}


def mask_cells(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): counted documents of each part and failure mask (bit i: i-th letter fails)."""
    tests = text_filters(F.col("_text"))
    bits = _bits("".join(tests) + DUPLICATE)
    base = docs.select(docs[doc_id].cast("long").alias("_id"), F.coalesce(docs[source].cast("string"), F.lit("")).alias("part"),
                       text_of(docs, text).alias("_text"))
    rows = base.select("_id", "part", F.unhex(F.sha2("_text", 256)).alias("digest"),
                       sum((F.when(t, bits[x]).otherwise(0) for x, t in tests.items()), F.lit(0)).alias("mask"))
    # rows that agree in everything are counted first; then the texts of one id meet its label
    rows = rows.groupBy("_id", "digest", "part", "mask").agg(F.count("*").alias("n"))
    flag = {c: F.max(F.coalesce(labels[c] == 1, F.lit(False))).alias(f"_{c}") for c in ("quality", "toxic")}
    known = labels.groupBy(labels["doc_id"].cast("long").alias("_label_id")).agg(*flag.values())
    rows = rows.join(known, F.col("_id") == F.col("_label_id"), "left")
    # copies of a text: counted by part and label, with the smallest id among them and its rows
    good, toxic = (F.coalesce(c, F.lit(False)) for c in ("_quality", "_toxic"))
    copies = rows.groupBy("digest", "part", "mask", good.alias("good"), toxic.alias("toxic")).agg(
        F.sum("n").alias("n"), F.min("_id").alias("first_id"),
        F.coalesce(F.min_by("n", "_id"), F.lit(0)).alias("n_first"),
        F.sum(F.when(F.col("_id").isNull(), F.col("n")).otherwise(0)).alias("n_null"))
    firsts = copies.groupBy(F.col("digest").alias("_digest")).agg(F.min("first_id").alias("least_id"))
    copies = copies.join(firsts, F.col("digest") == F.col("_digest"))
    stay = F.col("n_null") + F.when(F.col("first_id") == F.col("least_id"), F.col("n_first")).otherwise(0)
    outcome = F.explode(F.array(*[F.struct(F.col("mask").bitwiseOR(F.lit(bit)).alias("mask"), n.alias("n"))
                                  for bit, n in ((0, stay), (bits[DUPLICATE], F.col("n") - stay))]))
    split = copies.select("part", "good", "toxic", outcome.alias("o")).where("o.n > 0")
    weigh = lambda c: F.sum(F.when(F.col(c), F.col("o.n")).otherwise(0)).alias(c)
    return split.groupBy("part", F.col("o.mask").alias("mask")).agg(F.sum("o.n").alias("n"), weigh("good"), weigh("toxic"))


def _bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also inside lambdas."""
    return F.transform(F.array(value), body)[0]


def _fold(mask: Column, order: Column, bit: Column) -> Column:
    """Fold a mask along one order: a struct for each step with the step's letter, its failure, and whether an earlier one removed."""
    start = F.struct(F.lit(False).alias("gone"), F.expr("cast(array() as array<struct<letter:string,fails:boolean,gone:boolean>>)").alias("steps"))

    def step(held, letter):
        fails = mask.bitwiseAND(F.element_at(bit, letter)) != 0
        seen = F.struct(letter.alias("letter"), fails.alias("fails"), held["gone"].alias("gone"))
        return F.struct((held["gone"] | fails).alias("gone"), F.concat(held["steps"], F.array(seen)).alias("steps"))

    return F.aggregate(F.split(order, ""), start, step, lambda held: held["steps"])


def fold_orders(cells: DataFrame, letters: str) -> DataFrame:
    """One row for each (part, order, step): the cells' folds, summed element by element."""
    orders = ["".join(p) for p in itertools.permutations(letters)]
    table = F.array(*map(F.lit, orders))
    bit = F.create_map(*[F.lit(v) for x, b in _bits(letters).items() for v in (x, b)])
    place = F.create_map(*[F.lit(v) for i, x in enumerate(letters, 1) for v in (x, i)])

    def weighted(folds):
        """The cell's folds (one array of steps for each order) -> one struct for each order and step."""
        first = lambda steps: F.get(F.filter(steps, lambda s: s["fails"] & ~s["gone"]), F.lit(0))["letter"]
        credit = F.transform(F.array(*map(F.lit, letters)), lambda x: F.aggregate(
            folds, F.lit(0), lambda held, steps: held + F.when(first(steps) == x, 1).otherwise(0)))

        def one(s, shares):
            removed, n = s["fails"] & ~s["gone"], F.col("n")
            count = lambda test, w=n: F.when(test, w).otherwise(F.lit(0).cast("long"))
            return F.struct(count(~s["fails"] & ~s["gone"]).alias("kept"), count(removed).alias("removed"),
                            count(s["fails"] & s["gone"]).alias("redundant"),
                            count(F.col("mask") == F.element_at(bit, s["letter"])).alias("unique_fails"),
                            count(removed, F.col("good")).alias("good_lost"), count(removed, F.col("toxic")).alias("toxic_lost"),
                            (n * F.element_at(shares, F.element_at(place, s["letter"]))).alias("shapley"))

        return _bound(credit, lambda shares: F.flatten(F.transform(folds, lambda steps: F.transform(steps, lambda s: one(s, shares)))))

    folds = F.transform(table, lambda o: _fold(F.col("mask"), o, bit))
    vectors = cells.select("part", F.posexplode(_bound(folds, weighted)).alias("at", "cell"))
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    summed = vectors.groupBy("part", "at").agg(*[F.sum(f"cell.{c}").alias(c) for c in names])
    width = len(letters)
    return summed.select("part", F.element_at(table, (F.col("at") / width).cast("int") + 1).alias("filter_order"),
                         (F.col("at") % width + 1).cast("int").alias("step"), *names)


def filter_audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row for each part, order of the five filters and step."""
    return fold_orders(mask_cells(docs, labels, doc_id, text, source), "ABCD" + DUPLICATE)
