"""Document fingerprints: the least closed syncmers of a text, compared by hash and place."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.storage import checkpointed

# Code points of an anchor and of its inner substrings; the first is a multiple of the second.
ANCHOR_CHARS = 8
INNER_CHARS = 4
# Anchors a fingerprint holds: those of least hash, spread evenly over the text.
ANCHORS = 32
# Ascending anchors that are looked at first for distinct ones.
_FEW = 4 * ANCHORS
# Code points by which places of common anchors may be shifted against each other.
SLACK = 32
# Long texts are read in pieces of that many code points.
_PIECE = 1 << 16
_PLACE_BITS = 32
_HASH_MASK = (1 << 31) - 1


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _packed(hash_: Column, place: Column) -> Column:
    return F.shiftleft(hash_.bitwiseAND(F.lit(_HASH_MASK)), _PLACE_BITS).bitwiseOR(place.cast("long"))


def _hash_of(anchor: Column) -> Column:
    return F.shiftright(anchor, _PLACE_BITS)


def _place_of(anchor: Column) -> Column:
    return anchor.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))


def _anchors(piece: Column, start: Column) -> Column:
    """Closed syncmers of a piece that begins at ``start`` of its text, as hash and place in one number.

    Every ``INNER_CHARS`` code points are hashed. A run of ``ANCHOR_CHARS`` is chosen if the least of
    its inner hashes is the first or the last: that depends on the run alone, so equal passages have
    the same anchors whatever stands round them. Its own hash is that of the inner ones it is made of.
    """
    window = ANCHOR_CHARS - INNER_CHARS + 1
    inner = F.transform(
        F.regexp_extract_all(piece, F.lit(f"(?s)(?=(.{{{INNER_CHARS}}}))."), F.lit(1)),
        lambda part: F.xxhash64(part),
    )

    def chosen(hashes: Column) -> Column:
        at = lambda i, k: F.get(hashes, i + k)
        last = F.size(hashes) - window
        starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(
            F.expr("CAST(array() AS ARRAY<INT>)")
        )
        closed = F.filter(
            starts,
            lambda i: F.least(at(i, 0), at(i, window - 1)) <= F.least(*[at(i, k) for k in range(1, window - 1)]),
        )
        parts = range(0, ANCHOR_CHARS, INNER_CHARS)
        return F.transform(
            closed, lambda i: _packed(F.xxhash64(*[at(i, k) for k in parts]), start + i)
        )

    return _let(inner, chosen)


def _all_anchors(text: Column, begin: Column, chars: Column) -> Column:
    """All anchors of a text of ``chars`` code points from ``begin`` on.

    Pieces of a long text overlap by an anchor less one code point, which changes nothing: anchors
    do not depend on what is round them.
    """
    starts = F.sequence(begin, F.greatest(chars - 1, begin), F.lit(_PIECE))
    return F.flatten(
        F.transform(
            starts,
            lambda start: _anchors(F.substring(text, start + 1, F.lit(_PIECE + ANCHOR_CHARS - 1)), start),
        )
    )


def _first(ordered: Column, kept: Callable[[Column], Column] | None = None) -> Column:
    """The ``ANCHORS`` first distinct of ascending anchors, of the ``kept`` ones if given.

    They mostly lie among the first few; where repeats leave too few there, all are looked at.
    """

    def distinct(part: Column) -> Column:
        own = part if kept is None else F.filter(part, kept)
        return _let(
            own,
            lambda all_: F.slice(
                F.filter(
                    all_, lambda a, i: (i == 0) | (_hash_of(a) != _hash_of(F.get(all_, i - 1)))
                ),
                1,
                ANCHORS,
            ),
        )

    return _let(
        distinct(F.slice(ordered, 1, _FEW)),
        lambda few: F.when(
            (F.size(few) >= ANCHORS) | (F.size(ordered) <= _FEW), few
        ).otherwise(distinct(ordered)),
    )


def _least(found: Column) -> Column:
    """The ``ANCHORS`` distinct anchors of least hash, each with its first place, ascending."""
    return _let(F.sort_array(found), lambda ordered: _first(ordered))


def _or_whole(anchors: Column, text: Column) -> Column:
    """A text too short to have an anchor is its own."""
    alone = F.array(_packed(F.xxhash64(text), F.lit(0)))
    return _let(anchors, lambda found: F.when(F.size(found) == 0, alone).otherwise(found))


def sketch(text: Column, chars: Column) -> Column:
    """The fingerprint of a text of ``chars`` code points: its least anchors, an ascending array."""
    return _or_whole(_let(_all_anchors(text, F.lit(0), chars.cast("int")), _least), text)


def shown(anchors: Column) -> Column:
    """A fingerprint as text: ``hash:place`` in ascending order of the hashes, comma-joined."""
    one = lambda a: F.concat(
        F.lower(F.lpad(F.hex(_hash_of(a)), 8, "0")), F.lit(":"), _place_of(a).cast("string")
    )
    return F.array_join(F.transform(anchors, one), ",")


def likeness(left: Column, right: Column) -> Column:
    """How far, 0 to 1, two fingerprints share their anchors at places that fit together.

    Only anchors up to a hash that both fingerprints cover are compared. Shared ones count if
    their places are shifted by the usual shift of all shared ones, up to ``SLACK``; the result is the
    mean of their shares of either side, so that a text in which a passage is repeated stays like itself.
    """

    def covered(anchors: Column) -> Column:
        """A fingerprint with fewer anchors than it could hold has all of its text's."""
        return F.when(F.size(anchors) >= ANCHORS, _hash_of(F.element_at(anchors, -1))).otherwise(
            F.lit(_HASH_MASK).cast("long")
        )

    def compared(a: Column, b: Column) -> Column:
        least = F.least(covered(a), covered(b))
        mine, yours = (F.filter(x, lambda y: _hash_of(y) <= least) for x in (a, b))
        shifts = F.flatten(
            F.transform(
                a,
                lambda x: F.transform(
                    F.filter(b, lambda y: _hash_of(y) == _hash_of(x)), lambda y: _place_of(y) - _place_of(x)
                ),
            )
        )

        def fitting(ordered: Column) -> Column:
            usual = F.get(ordered, F.floor(F.size(ordered) / 2).cast("int"))
            return F.size(F.filter(ordered, lambda s: F.abs(s - usual) <= SLACK))

        def shares(number: Column) -> Column:
            share = lambda x: F.coalesce(F.try_divide(number, F.size(x)), F.lit(0.0))
            return (share(mine) + share(yours)) / 2

        return _let(_let(F.sort_array(shifts), fitting), shares)

    return _let(F.struct(left.alias("a"), right.alias("b")), lambda s: compared(s["a"], s["b"]))


def fingerprints(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, n_chars, anchors) of whole texts, row by row; ``shown`` and ``likeness`` read the anchors.

    A null text is empty; an empty text is its own anchor. Rows with null or repeated ids are rows
    like any other; an empty table gives an empty result. Columns other than the two named are
    not carried. Built-in functions only; nothing is shuffled.
    """
    rows = documents.select(F.col(id_column), F.coalesce(F.col(text_column), F.lit("")).alias("__text"))
    rows = rows.withColumn("__chars", F.char_length("__text"))
    return rows.select(
        id_column, F.col("__chars").cast("long").alias("n_chars"), sketch(F.col("__text"), F.col("__chars")).alias("anchors")
    )


def _successors(keys: DataFrame) -> DataFrame:
    """(key, n_chars, copies, next) in ascending order of ids and texts; the last one leads to the first.

    Rows are ranged and sorted, and numbered in that order; only the ends of the ranges, one row
    per range, meet to find where the next one begins.
    """
    ranged = keys.repartitionByRange("key").sortWithinPartitions("key")
    numbered = checkpointed(ranged.withColumn("place", F.monotonically_increasing_id()))
    ends = (
        numbered.groupBy(F.shiftright("place", 33).alias("range"))
        .agg(F.min("place").alias("first"), F.max("place").alias("last"))
        .withColumn("after", F.lead("first").over(Window.orderBy("range")))
        .withColumn("least", F.min("first").over(Window.partitionBy(F.lit(0))))
        .select("last", F.coalesce("after", "least").alias("after"))
    )
    # One row per range.
    known = numbered.join(F.broadcast(ends), numbered["place"] == ends["last"], "left").select(
        "key", "n_chars", "copies", F.coalesce("after", F.col("place") + 1).alias("place")
    )
    return known.join(numbered.select("place", F.col("key").alias("next")), "place").drop("place")


def edited_fingerprints(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) per row.

    The edited text is the text with its last quarter, rounded down, replaced by the first as many code
    points of the next document. Next is the one of the next larger id, behind the last one the first;
    rows of one id follow each other by the hashes of their texts, null ids come first. ``near_edited``
    and ``near_next`` are the likeness to the fingerprints of the edited text and of the next document.

    Rows equal in id and text are computed once and repeated: each but the last is followed by its
    equal. Texts are shuffled once by id and hash, and a quarter of them once more. A null text is
    empty, and an empty text stays empty when edited. A table of one row is its own next document;
    an empty table gives an empty result. Columns other than the two named are not carried.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = documents.select(
        F.struct(F.col(id_column).alias("id"), F.xxhash64(text).alias("tie")).alias("key"), text.alias("text")
    ).withColumn("n_chars", F.char_length("text"))
    keys = rows.groupBy("key").agg(F.max("n_chars").alias("n_chars"), F.count("*").alias("copies"))
    after = checkpointed(_successors(keys))
    # Copies lead to each other, the last one on.
    steps = F.array(
        F.struct("next", F.lit(1).cast("long").alias("times")),
        F.struct(F.col("key").alias("next"), (F.col("copies") - 1).alias("times")),
    )
    steps = after.select("key", "n_chars", F.explode(steps).alias("s")).select("key", "n_chars", "s.*")
    steps = steps.filter("times > 0")
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    kept = F.col("n_chars") - quarter
    # Whole texts are read for anchors where they are scanned. What lies in the kept part belongs to
    # the edited text as well; only the seam and the new end are read again.
    both = _let(
        F.sort_array(_all_anchors(F.col("text"), F.lit(0), F.col("n_chars"))),
        lambda ordered: F.struct(
            _or_whole(_first(ordered), F.col("text")).alias("anchors"),
            _first(ordered, lambda a: _place_of(a) + ANCHOR_CHARS <= kept).alias("kept_anchors"),
        ),
    )
    texts = rows.groupBy("key").agg(F.first(F.struct("text", "n_chars", both.alias("of"))).alias("row"))
    tails = steps.join(texts.withColumnRenamed("key", "next"), "next").select(
        "key", "next", "times", F.substring("row.text", F.lit(1), quarter).alias("tail")
    )
    edited = texts.join(tails, "key").select(
        "key",
        "next",
        "times",
        "row.n_chars",
        "row.of.*",
        F.concat(
            F.substring("row.text", F.lit(1), (F.col("row.n_chars") - F.floor(F.col("row.n_chars") / 4)).cast("int")),
            "tail",
        ).alias("edited"),
    )
    seam = F.greatest(kept - (ANCHOR_CHARS - 1), F.lit(0))
    new = _all_anchors(F.col("edited"), seam, F.char_length("edited"))
    made = checkpointed(
        edited.select(
            "key",
            "next",
            "times",
            "n_chars",
            F.sha2("edited", 256).alias("edited_sha256"),
            "anchors",
            _let(
                F.concat("kept_anchors", new), lambda found: _or_whole(_least(found), F.col("edited"))
            ).alias("edited_anchors"),
        )
    )
    others = made.groupBy(F.col("key").alias("next")).agg(F.first("anchors").alias("next_anchors"))
    return (
        made.join(others, "next")
        .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
        .select(
            F.col("key.id").alias(id_column),
            F.col("n_chars").cast("long").alias("n_chars"),
            "edited_sha256",
            shown(F.col("anchors")).alias("fingerprint"),
            shown(F.col("edited_anchors")).alias("edited_fingerprint"),
            likeness(F.col("anchors"), F.col("edited_anchors")).alias("near_edited"),
            likeness(F.col("anchors"), F.col("next_anchors")).alias("near_next"),
        )
    )
