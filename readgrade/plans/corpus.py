"""From documents to metrics: the flow behind the feature table."""

from pyspark.sql import DataFrame

from readgrade.operators import lexicon as L, metrics as M, tokens as T
from readgrade.plans.storage import materialise


def build_forms(tokens: DataFrame) -> DataFrame:
    """The vocabulary of a corpus as a stored table: one pass over the tokens, one row per word form."""
    counted = materialise(L.word_forms(tokens), "forms")
    return L.mark_hot(counted)


def build_lexicon(forms: DataFrame, wordlist: DataFrame, freq: DataFrame | None = None, list_tags: bool = False) -> DataFrame:
    """Graded forms as a stored table, so that the cascade runs once and later joins read plain columns."""
    forms = L.retag_forms(forms, wordlist) if list_tags else forms
    return materialise(L.grade_forms(forms, wordlist, freq), "lexicon")


def counts_of(tokens: DataFrame, graded: DataFrame, docs: DataFrame) -> DataFrame:
    """Counts of every document by the classes that ``graded`` has."""
    counts = M.retagged_counts(tokens, graded) if "tag_pos" in graded.columns else M.document_counts(tokens, graded)
    return M.with_blank_counts(counts, docs)


def metrics_of(docs: DataFrame, wordlist: DataFrame, variant: str = "profile", freq: DataFrame | None = None,
               tokens: DataFrame | None = None, list_tags: bool = False) -> DataFrame:
    """The eight metrics of every document, zeros for blank texts.

    Pass ``tokens`` to use another annotator's token table. With ``list_tags`` the graded list decides the class of open-class
    words before their ending does; it is asked once per word form.
    """
    tokens = T.tokens(docs) if tokens is None else tokens
    graded = build_lexicon(build_forms(tokens), wordlist, freq, list_tags)
    return M.metrics(counts_of(tokens, graded, docs), variant)
