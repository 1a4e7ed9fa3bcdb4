"""Column functions over text and surfaces: cleaning, types, lexicons, gates."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocabulary as V


def clean_text(text: Column) -> Column:
    """URLs, then markdown characters, go; blanks collapse; at most two line feeds; trimmed."""
    out = F.regexp_replace(text, r"https?://\S+", "")
    out = F.regexp_replace(out, r"[*_~`#>\[\]()!]", "")
    out = F.regexp_replace(out, r"[ \t]+", " ")
    out = F.regexp_replace(out, r"\n{3,}", "\n\n")
    return F.regexp_replace(out, r"^\s+|\s+$", "")


def has_keyword(text: Column, words: list[str] | None = None, cjk: list[str] | None = None) -> Column:
    """A whole word of `words` (patterns), or one of `cjk` anywhere; case doesn't matter."""
    words, cjk = words or V.KEYWORDS, V.KEYWORDS_CJK if cjk is None else cjk
    return text.rlike("(?iu)" + "|".join([r"\b(?:" + "|".join(words) + r")\b", *cjk]))


def collapse_to_base(kind: Column) -> Column:
    return F.substring_index(F.substring_index(kind, "/", 1), " -> ", 1)


def sync_type(raw: Column) -> Column:
    """The vocabulary's name of a type written with an arrow or a colon; null if it has none."""
    name = raw
    for sign in (" -> ", "->", ": ", ":"):
        name = F.replace(name, F.lit(sign), F.lit("/"))
    name = F.trim(name)
    return F.when(name.isin(V.SYNC_TYPES), name)


def canonical_type(raw: Column) -> Column:
    """The type if it is canonical, else its base if that is; null otherwise."""
    name = F.replace(raw, F.lit(":"), F.lit("/"))
    base = F.substring_index(name, "/", 1)
    return F.when(name.isin(V.CANONICAL_TYPES), name).when(base.isin(V.CANONICAL_TYPES), base)


def is_pronoun(surface: Column) -> Column:
    return F.lower(F.trim(surface)).isin(V.PRONOUNS)


def is_noise(kind: Column, surface: Column) -> Column:
    out = F.lit(False)
    for prefix, words in V.NOISE.items():
        out |= kind.startswith(prefix) & surface.isin(words)
    for k, s in V.NOISE_EXACT:
        out |= (kind == k) & (surface == s)
    return out


def event_subtype(surface: Column, life=V.EVENT_LIFE, general=V.EVENT_GENERAL, false=V.EVENT_FALSE) -> Column:
    """Life before General, by substrings of the surface without one determiner; known false ones are null."""
    plain = F.trim(F.regexp_replace(F.lower(F.trim(surface)), r"^(the|a|my|his|her|our|their)\s+", ""))
    any_of = lambda words: plain.rlike("|".join(map(re.escape, words)))
    return F.when(plain.isin(false), None).when(any_of(life), "EVENT/Life").when(any_of(general), "EVENT/General")


def plain_relation(surface: Column) -> Column:
    """Lower case, without one possessive, one article and a final 's."""
    out = F.regexp_replace(F.lower(surface), "^(my|our|his|her|their|your) ", "")
    out = F.regexp_replace(out, "^(the|a|an) ", "")
    return F.trim(F.regexp_replace(out, "'s$", ""))


def relation_subtype(surface: Column, lexicons=V.RELATIONS) -> Column:
    """The first lexicon that has the plain surface, one of its tokens, or a phrase within it."""
    plain = plain_relation(surface)
    tokens = F.split(plain, r"\s+")
    out = None
    for name, words in lexicons:
        single, phrases = [w for w in words if " " not in w], [w for w in words if " " in w]
        hit = F.arrays_overlap(tokens, F.array(*map(F.lit, single)))
        for p in phrases:
            hit |= plain.contains(p)
        out = (F if out is None else out).when(hit, f"RELATIONSHIP_REF/{name}")
    return out


def is_specific(surface: Column, context: Column) -> Column:
    """Inherently specific words are; undecided ones aren't; else a possessive or demonstrative must precede."""
    low = F.lower(surface)
    quoted = F.concat(F.lit("\\Q"), surface, F.lit("\\E"))
    led = lambda lead: F.coalesce(F.regexp_like(context, F.concat(F.lit(f"(?iu){lead}\\s+"), quoted)), F.lit(False))
    return F.when(low.isin(V.SPECIFIC), True).when(low.isin(V.UNDECIDED), False).otherwise(led(r"\b(?:my|our|his|her|their|your)") | led(r"\w+'s") | led(r"\b(?:that|this|the)"))


def base_id(source_id: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(source_id, "_canonical$", ""), r"__(w|chunk)\d+$", "")


def context_window(text: Column, start: Column, end: Column, around: int = 100) -> Column:
    left = F.greatest(F.lit(0), start - around)
    return F.substring(text, left + 1, end + around - left)


def bucket(confidence: Column, fmt: Column, language: Column, source: Column) -> Column:
    gold = confidence.isin("human-gold", "synthetic-gold", "gold")
    silver = F.when(~fmt.eqNullSafe("conversation"), "gold").when(F.coalesce(language, F.lit("en")) == "en", "silver_en").otherwise("silver_ml")
    other = F.when(F.coalesce(source.rlike("^(multilingual_|ml_synthetic_|silver_ml_)"), F.lit(False)), "silver_ml").otherwise("gold")
    return F.when(gold, "gold").when(confidence == "silver", silver).otherwise(other)


def json_list(raw: Column) -> Column:
    """The array in a model's answer: code fences stripped, the widest brackets, else braces as a list."""
    plain = F.regexp_replace(F.regexp_replace(F.trim(raw), "^```(?:json)?\n?", ""), "\n?```$", "")
    listed, single = F.regexp_extract(plain, r"(?s)\[.*\]", 0), F.regexp_extract(plain, r"(?s)\{.*\}", 0)
    fine = lambda c: (c != "") & F.try_parse_json(c).isNotNull()
    wrapped = F.concat(F.lit("["), single, F.lit("]"))
    return F.when(fine(listed), listed).when((single != "") & fine(wrapped), wrapped)


def hash_order(*parts) -> Column:
    """A reproducible random order: the SHA-256 of the parts joined by '|'."""
    return F.sha2(F.concat_ws("|", *[p if isinstance(p, Column) else F.lit(str(p)) for p in parts]), 256)
