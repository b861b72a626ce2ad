"""Document type from the file name, language and topic from word lists."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from .binding import let

# Our own choice of general words for each category; callers pass others for their files.
NAME_WORDS: dict[str, tuple[str, ...]] = {
    "hr": ("hr", "personnel", "salary", "vacation", "staff", "recruitment", "employee", "training"),
    "finance": ("finance", "invoice", "budget", "ledger", "payment", "accounting", "tax", "audit", "balance"),
    "research": ("research", "study", "experiment", "dataset", "hypothesis", "laboratory", "thesis"),
    "engineering": ("engineering", "architecture", "blueprint", "deployment", "firmware", "schematic", "release"),
    "support": ("support", "ticket", "complaint", "refund", "helpdesk", "warranty", "faq"),
}

# Frequent function words of four languages.
LANGUAGE_WORDS: dict[str, tuple[str, ...]] = {
    "en": ("the", "of", "and", "to", "that", "is", "was", "with", "for", "on", "are", "this", "be", "have", "from"),
    "de": ("der", "die", "das", "und", "ist", "nicht", "von", "den", "auf", "sich", "dem", "für", "im", "mit", "zu"),
    "fr": ("le", "la", "les", "des", "et", "est", "que", "dans", "pour", "qui", "une", "pas", "avec", "sur", "du"),
    "es": ("el", "los", "las", "del", "que", "por", "con", "una", "para", "como", "se", "su", "al", "es", "y"),
}


def best_label(tokens: Column, words: Mapping[str, tuple[str, ...]]) -> Column:
    """Label with most tokens in its word list; the alphabetically first wins a tie, NULL if none hits."""

    def hits(arr: Column, own: tuple[str, ...]) -> Column:
        return F.size(F.filter(arr, lambda token: token.isin(*own)))

    def score(arr: Column) -> Column:
        # array_max takes the later rank on equal hits, so the first label gets the last rank
        ranked = F.array(
            *[
                F.struct(
                    hits(arr, own).alias("hits"),
                    F.lit(rank).alias("rank"),
                    F.lit(label).alias("label"),
                )
                for rank, (label, own) in enumerate(sorted(words.items(), reverse=True))
            ]
        )
        return let(F.array_max(ranked), lambda top: F.when(top["hits"] > 0, top["label"]))

    return let(tokens, score)


def by_name(name: Column, labels: tuple[str, ...], name_words: Mapping[str, tuple[str, ...]] = NAME_WORDS) -> Column:
    """Suffix ``_<label>`` before the extension, else words of the name, else NULL."""
    stem = F.lower(F.regexp_replace(name, r"\.[^.]*$", ""))
    suffix = F.regexp_extract(stem, f"_({'|'.join(labels)})$", 1)
    known = {label: words for label, words in name_words.items() if label in labels}
    return F.when(suffix != "", suffix).otherwise(best_label(F.split(stem, "[^a-z0-9]+", -1), known))


def language(text: Column) -> Column:
    return best_label(F.split(F.lower(text), r"[^\p{L}]+", -1), LANGUAGE_WORDS)
