"""The driver's tables and what is derived from them, one instance per session and folder.

The vocabulary, the lexicon and the document counts are stored tables: built
once, then read by every query of the session.
"""

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog import fixtures as FX
from readgrade import fixed as C
from readgrade.functions import text as X
from readgrade.operators import lexicon as L, metrics as M, profiles as P, requests as RQ, responses as RS, tokens as T
from readgrade.plans import corpus as flow
from readgrade.plans.storage import materialise
from readgrade.sources import corpus

_known: dict = {}


def data(spark: SparkSession, folder: str) -> "Data":
    key = (spark.sparkContext.applicationId, str(folder).rstrip("/"))
    if key not in _known:
        _known[key] = Data(spark, key[1])
    return _known[key]


class Data:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @property
    def partitions(self) -> int | None:
        """What the session asks for its small local files; nothing on a cluster."""
        asked = self.spark.conf.get("spark.readgrade.partitions", None)
        return int(asked) if asked else None

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    @property
    def docs(self) -> DataFrame:
        return corpus.documents(self.spark, self.path("documents"), "en", self.partitions)

    @property
    def all_docs(self) -> DataFrame:
        return corpus.documents(self.spark, self.path("documents"), None, self.partitions)

    @property
    def tokens(self) -> DataFrame:
        return T.tokens(self.docs)

    @cached_property
    def forms(self) -> DataFrame:
        return flow.build_forms(self.tokens)

    @property
    def wordlist(self) -> DataFrame:
        return FX.wordlist(self.forms)

    @cached_property
    def lexicon(self) -> DataFrame:
        return flow.build_lexicon(self.forms, self.wordlist)

    @cached_property
    def counts(self) -> DataFrame:
        return materialise(flow.counts_of(self.tokens, self.lexicon, self.docs), "counts")

    @cached_property
    def listed_counts(self) -> DataFrame:
        """Counts with the classes of the list, in both variants' queries."""
        lexicon = flow.build_lexicon(self.forms, self.wordlist, list_tags=True)
        return materialise(flow.counts_of(self.tokens, lexicon, self.docs), "listed-counts")

    def metrics(self, variant: str) -> DataFrame:
        return M.metrics(self.counts, variant)

    @property
    def features(self) -> DataFrame:
        return self.metrics("profile").select(
            F.concat(F.lit("Text_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("filename"), "*",
            FX.text_level(F.col("ARI")).alias("predict_level"))

    @cached_property
    def stored_features(self) -> DataFrame:
        """Feature table for the classifier: training reads it many times."""
        return materialise(self.features, "features")

    @property
    def grouped(self) -> DataFrame:
        return P.group_levels(self.features)

    @property
    def profiles(self) -> DataFrame:
        return P.level_profiles(self.grouped)

    @property
    def attempts(self) -> DataFrame:
        return FX.attempts(self.docs)

    @property
    def scored(self) -> DataFrame:
        """Attempts with metrics, targets, deltas and distance."""
        levels = P.group_levels(self.attempts.withColumnRenamed("target_level", "predict_level"))
        rows = levels.withColumnRenamed("predict_level", "target_level").join(self.metrics("profile"), "doc_id")
        return P.deltas(rows, self.profiles).withColumn("distance", P.distance())

    @property
    def limits(self) -> DataFrame:
        return FX.max_ranks(self.docs)

    @property
    def lexical(self) -> DataFrame:
        """The number of tokens comes from the stored counts only if some query has stored them."""
        return L.lexical_profile(self.tokens, self.lexicon, self.limits, vars(self).get("counts"))

    @cached_property
    def measured(self) -> DataFrame:
        """Counts of every text in all languages, stored: numbers only, so the texts are cut up once."""
        docs = corpus.dealt(self.table("documents").select("doc_id", "lang", "source", "text"), self.partitions)
        return materialise(docs.select(
            "doc_id", "lang", "source", X.whitespace_words(F.col("text")).alias("word_count"),
            X.letter_total(F.col("text")).alias("n_letters"), X.word_total(F.col("text")).alias("n_words"),
            X.sentence_total(F.col("text")).alias("n_sents")), "measured")

    @property
    def results(self) -> DataFrame:
        """A light result table over all languages without the texts: predicted level from ARI."""
        rows = FX.attempts(self.measured).select(
            "*", (100 + 25 * (F.col("request_id") % 5)).alias("wanted_words"),
            F.when(F.col("doc_id") % 2 == 0, "narrative").otherwise("expository").alias("text_type"),
            F.concat("lang", F.lit(" texts collected from the source "), "source").alias("topic"),
            X.ari(F.col("n_letters"), F.col("n_words"), F.col("n_sents")).alias("ARI"))
        rows = rows.select("*", FX.text_level(F.col("ARI")).alias("predicted_level"),
                           (F.floor(1.0 / (1.0 + F.abs(F.col("ARI") - 7.0)) * 10000.0 + 0.5).cast("double") / 10000.0)
                           .alias("confidence"), F.col("attempt").alias("attempts"))
        return rows.select(
            "*", RS.success(F.col("word_count"), F.col("wanted_words"), F.col("predicted_level"),
                            F.col("target_level")).alias("success"),
            RS.level_distance(F.col("predicted_level"), F.col("target_level")).alias("distance"))

    @property
    def result_texts(self) -> DataFrame:
        """Results with text, questions and features."""
        number = F.col("doc_id") % 3
        asked = (F.when(number == 0, F.array().cast("array<string>")).when(number == 1, F.array(F.lit("What?")))
                 .otherwise(F.array(F.lit("What?"), F.concat(F.lit('Why "'), "source", F.lit('"?')))))
        return (self.results.join(self.table("documents").select("doc_id", "text"), "doc_id")
                .select("*", asked.alias("questions"), F.col("request_id").alias("set_index"),
                        F.when(F.col("doc_id") % 5 != 0, F.concat(F.col("attempt").cast("string"), F.lit("K"))).alias("band"),
                        F.struct("ARI").alias("features"), F.col("target_level").alias("level")))

    @property
    def parsed(self) -> DataFrame:
        docs = corpus.dealt(self.table("documents").select("doc_id", "text", "source"), self.partitions)
        return RS.parse_answers(FX.responses(docs))

    @property
    def topics(self) -> DataFrame:
        """One topic per benchmark item: its text."""
        return self.table("benchmark").select(F.col("item_id").alias("set_index"), F.col("text").alias("topic"))

    @property
    def planned(self) -> DataFrame:
        return RQ.plan_sets(self.topics.select("set_index"))

    @property
    def level_requests(self) -> DataFrame:
        """Topics at every level, with the number of the attempt and the wanted words varied."""
        number = F.col("set_index")
        return RQ.plan_levels(self.topics).select(
            "set_index", "topic", "target_level", (number % 4 + 1).alias("attempt"), (75 + 25 * (number % 6)).alias("word_count"))

    @property
    def type_requests(self) -> DataFrame:
        """Every topic for every level group in the text type of its item."""
        groups = list(dict.fromkeys(g for _, g, _ in C.LEVEL_GROUPS))
        kind = F.when(F.col("set_index") % 2 == 0, "narrative").otherwise("expository")
        return RQ.plan_levels(self.topics, groups).select("set_index", "topic", F.col("target_level").alias("level"),
                                                          kind.alias("text_type"))
