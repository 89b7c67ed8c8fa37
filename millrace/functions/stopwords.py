"""Stop words dropped by the word counts, by language."""

from __future__ import annotations

# The word lists decide the results.
ENGLISH = (
    "a", "about", "after", "again", "all", "am", "an", "and", "any", "are",
    "as", "at", "be", "been", "before", "but", "by", "can", "could", "did",
    "do", "does", "for", "from", "had", "has", "have", "he", "her", "here",
    "him", "his", "how", "i", "if", "in", "into", "is", "it", "its", "me",
    "more", "my", "no", "not", "now", "of", "on", "one", "only", "or",
    "other", "our", "out", "over", "said", "she", "should", "so", "some",
    "than", "that", "the", "their", "them", "then", "there", "these",
    "they", "this", "those", "to", "too", "up", "upon", "very", "was", "we",
    "were", "what", "when", "where", "which", "while", "who", "whom", "why",
    "will", "with", "would", "you", "your",
)

# Fixed values.
FRENCH = (
    "a", "à", "ai", "au", "aux", "avait", "avec", "c", "ce", "cela", "ces",
    "cet", "cette", "comme", "d", "dans", "de", "des", "dit", "donc", "du",
    "elle", "en", "est", "et", "été", "était", "être", "il", "ils", "j",
    "je", "l", "la", "le", "les", "leur", "lui", "m", "mais", "me", "même",
    "mon", "n", "ne", "nous", "on", "ou", "où", "par", "pas", "pour",
    "qu", "que", "qui", "s", "sa", "sans", "se", "ses", "si", "son", "sont",
    "sur", "t", "tout", "un", "une", "vous", "y", "plus", "bien", "très",
    "ont", "fait", "avoir", "dont", "alors", "encore",
)

BY_LANGUAGE = {"en": ENGLISH, "fr": FRENCH}
