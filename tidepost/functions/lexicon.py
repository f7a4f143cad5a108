"""Lexicon scores as row-local expressions: no explode, no join, no shuffle.

A word is first tested against a constant set (one hash probe); only words found there
pay for the map look-up and for reading the words before them. A lexicon is a mapping from a word
to (valence, polarity, subjectivity) that becomes a constant; one that is too large for that is a
table, see ``operators.lexicon_table``, which shares the rules below.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidepost import rules
from tidepost.functions.binding import bind

WORD_PATTERN = r"[\p{L}\p{N}]+(?:'[\p{L}\p{N}]+)*"


def lexicon_words(text: Column, keep_case: bool = False) -> Column:
    """Words with inner apostrophes kept and outer punctuation gone."""
    source = text if keep_case else F.lower(text)
    return F.regexp_extract_all(source, F.lit(WORD_PATTERN), F.lit(0))


def _constant_map(values: dict[str, float]) -> Column:
    """Word -> number, folded into one literal when the plan is optimised."""
    pairs = F.str_to_map(F.lit(",".join(f"{k}:{v}" for k, v in values.items())), F.lit(","), F.lit(":"))
    return pairs.cast("map<string,double>")


def _is_one_of(word: Column, few: tuple[str, ...]) -> Column:
    """Membership in a short constant list; null is no member."""
    return F.coalesce(F.array_contains(F.split(F.lit(" ".join(few)), " "), word), F.lit(False))


Lexicon = Mapping[str, tuple[float, float, float]]


def valence_context(words: Column, i: Column, contrast: Column, capitals: Column | None = None) -> tuple[Column, Column, Column]:
    """What the words around place ``i`` do to a valence there: shift, factor of negation, factor of
    contrast. ``contrast`` is the place of the contrast word, counted from 1, or 0.

    Degree words within three places before shift the valence, a negator there turns it,
    and a contrast word halves what precedes it and raises what follows. ``capitals`` is an
    array of flags: a word in capitals inside a mixed-case text counts for more.
    """
    shift_of = _constant_map(rules.DEGREE_SHIFT)
    before = [F.get(words, i - d) for d in (1, 2, 3)]
    shift = reduce(
        add,
        [
            F.coalesce(F.try_element_at(shift_of, b) * decay, F.lit(0.0))
            for b, decay in zip(before, rules.DEGREE_DECAY)
        ],
    )
    if capitals is not None:
        shift = shift + F.when(F.get(capitals, i), F.lit(rules.CAPITALS_STEP)).otherwise(0.0)
    turned = reduce(or_, [_is_one_of(b, rules.NEGATORS) for b in before])
    return (
        shift,
        F.when(turned, F.lit(rules.NEGATION_FACTOR)).otherwise(1.0),
        F.when(contrast == 0, F.lit(1.0))
        .when(i + 1 < contrast, F.lit(rules.BEFORE_CONTRAST))
        .otherwise(F.lit(rules.AFTER_CONTRAST)),
    )


def adjusted_valence(own: Column, shift: Column, turned: Column, contrasted: Column) -> Column:
    return bind(own, lambda v: v + F.signum(v) * shift) * turned * contrasted


def contrast_place(words: Column) -> Column:
    return F.array_position(words, rules.CONTRAST_WORD)


def word_valences(words: Column, capitals: Column | None = None, lexicon: Lexicon = rules.LEXICON) -> Column:
    """One adjusted valence per word, 0.0 for words outside the lexicon: see :func:`valence_context`."""
    valence_of = _constant_map({w: v[0] for w, v in lexicon.items()})

    def at(i: Column, contrast: Column) -> Column:
        own = F.try_element_at(valence_of, F.get(words, i))
        return adjusted_valence(own, *valence_context(words, i, contrast, capitals))

    def score_all(contrast: Column) -> Column:
        return F.transform(words, lambda w, i: F.when(w.isin(*lexicon), at(i, contrast)).otherwise(F.lit(0.0)))

    return bind(contrast_place(words), score_all) if lexicon else F.transform(words, lambda _: F.lit(0.0))


def _total(values: Column, value=lambda x: x) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + value(x))


def _exclamations(text: Column) -> Column:
    count = F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit("")))
    return F.least(count, F.lit(rules.EXCLAMATION_MAX)) * F.lit(rules.EXCLAMATION_STEP)


def _compound(total: Column, emphasis: Column) -> Column:
    def squash(s: Column) -> Column:
        return F.round(s / F.sqrt(s * s + F.lit(rules.COMPOUND_ALPHA)), 4)

    return bind(bind(total, lambda s: s + F.signum(s) * emphasis), squash)


def _from_valences(text: Column, body, lexicon: Lexicon) -> Column:
    safe = F.coalesce(text, F.lit(""))
    return bind(lexicon_words(safe), lambda ws: bind(word_valences(ws, lexicon=lexicon), body))


def valence_score(text: Column, lexicon: Lexicon = rules.LEXICON) -> Column:
    """Compound score in [-1, 1]; null or empty text is 0.0."""
    safe = F.coalesce(text, F.lit(""))
    return _from_valences(text, lambda vs: _compound(_total(vs), _exclamations(safe)), lexicon)


def raw_valence_score(text: Column) -> Column:
    """As :func:`valence_score` on uncleaned text, where words in capitals weigh more."""
    safe = F.coalesce(text, F.lit(""))

    def in_capitals(w: Column) -> Column:
        return (F.upper(w) == w) & (F.lower(w) != w)

    def scored(raw: Column, shouted: Column) -> Column:
        # a text all in capitals emphasises nothing
        mixed = F.exists(shouted, lambda s: s) & F.exists(shouted, lambda s: ~s)
        flags = F.transform(shouted, lambda s: s & mixed)
        return bind(
            F.transform(raw, F.lower),
            lambda ws: bind(
                flags, lambda caps: _compound(_total(word_valences(ws, caps)), _exclamations(safe))
            ),
        )

    return bind(
        lexicon_words(safe, keep_case=True),
        lambda raw: bind(F.transform(raw, in_capitals), lambda shouted: scored(raw, shouted)),
    )


def shares_of(values: Column, silent: Column, text: Column) -> Column:
    """``struct<compound, positive, neutral, negative>`` of the adjusted valences of a text, in order,
    and the number of its other words."""

    def shares(vs: Column) -> Column:
        sums = F.struct(
            _total(vs, lambda v: F.when(v > 0, v + 1.0).otherwise(0.0)).alias("up"),
            _total(vs, lambda v: F.when(v < 0, 1.0 - v).otherwise(0.0)).alias("down"),
            (_total(vs, lambda v: F.when(v == 0, F.lit(1.0)).otherwise(0.0)) + silent).alias("flat"),
        )

        def ratio(s: Column) -> Column:
            whole = s.getField("up") + s.getField("down") + s.getField("flat")

            def of(part: str) -> Column:
                return F.when(whole > 0, F.round(s.getField(part) / whole, 3)).otherwise(0.0)

            return F.struct(
                _compound(_total(vs), _exclamations(F.coalesce(text, F.lit("")))).alias("compound"),
                of("up").alias("positive"),
                of("flat").alias("neutral"),
                of("down").alias("negative"),
            )

        return bind(sums, ratio)

    return bind(values, shares)


def valence_shares(text: Column, lexicon: Lexicon = rules.LEXICON) -> Column:
    """``struct<compound, positive, neutral, negative>``; the three shares add up to 1."""
    return _from_valences(text, lambda vs: shares_of(vs, F.lit(0), text), lexicon)


def polarity_context(words: Column, i: Column) -> tuple[Column, Column]:
    """Factors on the polarity at place ``i``: of a degree word just before, and of a negator among the
    two words before."""
    before = [F.get(words, i - d) for d in (1, 2)]
    degree = F.coalesce(F.try_element_at(_constant_map(rules.DEGREE_FACTOR), before[0]), F.lit(1.0))
    turned = reduce(or_, [_is_one_of(b, rules.NEGATORS) for b in before])
    return degree, F.when(turned, F.lit(rules.POLARITY_NEGATION)).otherwise(1.0)


def adjusted_polarity(own: Column, degree: Column, turned: Column) -> Column:
    return F.least(F.greatest(own * degree, F.lit(-1.0)), F.lit(1.0)) * turned


def means_of(found: Column) -> Column:
    """``struct<polarity, subjectivity>`` of an array of (p, s); 0.0 for both if it is empty."""

    def mean(found: Column) -> Column:
        n = F.size(found)

        def of(part: str) -> Column:
            total = _total(found, lambda x: x.getField(part))
            return F.when(n > 0, F.round(total / n, 4)).otherwise(0.0)

        return F.struct(of("p").alias("polarity"), of("s").alias("subjectivity"))

    return bind(found, mean)


def polarity_parts(text: Column, lexicon: Lexicon = rules.LEXICON) -> Column:
    """``struct<polarity, subjectivity>``: means over the lexicon words of the text.

    A degree word just before scales the polarity (within [-1, 1]); a negator among the
    two words before multiplies it by -0.5. No lexicon word gives 0.0 for both.
    """
    polarity_of = _constant_map({w: v[1] for w, v in lexicon.items()})
    subjectivity_of = _constant_map({w: v[2] for w, v in lexicon.items()})

    def read(words: Column) -> Column:
        def one(w: Column, i: Column) -> Column:
            p = adjusted_polarity(F.try_element_at(polarity_of, w), *polarity_context(words, i))
            return F.when(w.isin(*lexicon), F.struct(p.alias("p"), F.try_element_at(subjectivity_of, w).alias("s")))

        return F.filter(F.transform(words, one), lambda x: x.isNotNull())

    if not lexicon:
        return F.struct(F.lit(0.0).alias("polarity"), F.lit(0.0).alias("subjectivity"))
    return bind(lexicon_words(F.coalesce(text, F.lit(""))), lambda ws: means_of(read(ws)))


def polarity_score(text: Column, lexicon: Lexicon = rules.LEXICON) -> Column:
    return polarity_parts(text, lexicon).getField("polarity")
