"""Word lists and patterns used by the text operators."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover

# Profiling stop words, token pattern and keyword lists.
PROFILE_STOP_WORDS = frozenset("""
the a an and or but if to of in on for is are was were be been being
this that these those i you he she it we they my your his her its our
their me him her us them am is are was were will would can could shall
should may might must with as at by from up down out about into over
after before dm please thanks thank you re your apple applesupport
""".split())
PROFILE_TOKEN = "[a-z']+"
THANK_WORDS = ("thanks", "thank you", "resolved", "fixed", "works now", "appreciate")
COMPLAINT_WORDS = ("still", "again", "worse", "no update", "not working", "ridiculous")

# Brand and markup words that topic discovery ignores.
DOMAIN_STOP_WORDS = frozenset(
    "apple applesupport iphone ipad ipod macbook imac ios https http com www rt amp co".split()
)

# Word of two or more letters, digits or underscores, in any script.
WORD = r"[\p{L}\p{N}_]{2,}"
# Latin word that starts with a letter; (?U) gives Unicode word boundaries on any JVM.
LATIN_WORD = r"(?U)\b[a-zA-Z][a-zA-Z']+\b"


def stop_words(extra: frozenset[str] = frozenset()) -> list[str]:
    """Spark's English stop words plus ``extra`` (needs an active session)."""
    return sorted(set(StopWordsRemover.loadDefaultStopWords("english")) | extra)
