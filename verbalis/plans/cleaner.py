"""The cleaning stage: raw text to lemmas, tokens for collocations and the twelve record statistics."""

from __future__ import annotations

from dataclasses import asdict

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.ml.param import Param, Params
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbalis.functions import text as T
from verbalis.functions.lexicons import Lexicons
from verbalis.functions.wordfacts import FACT_ROWS, collect_facts, facts_column
from verbalis.operators import cleaning as C
from verbalis.operators import rowstats as R
from verbalis.operators.lookup import lookup_join
from verbalis.session import Workspace

OUTPUTS = ("lemmas", "gram_tokens", *R.ALL_FEATURES)


class TextCleaner(Transformer, MLReadable, MLWritable):
    """Adds ``lemmas``, ``gram_tokens`` and one column per record statistic. Rows stay in place, so it also works on
    streams.

    ``facts`` is the word table of ``operators.cleaning.word_facts`` over the lexicon words. If it is larger than the
    broadcast bound, input is cleaned by joins over exploded tokens of records with generated keys (``joins`` is True
    then); streams are scored batch by batch in that form (``streaming.scoring`` does). Ids are not used in either form.
    """

    textCol = Param(Params._dummy(), "textCol", "column with the raw text")
    idCol = Param(Params._dummy(), "idCol", "column that identifies a record (not used)")
    profile = Param(Params._dummy(), "profile", "junk rules for lemmas")
    stopWords = Param(Params._dummy(), "stopWords", "stop words")
    gramSource = Param(Params._dummy(), "gramSource", "tokens in which collocations are counted: raw or clean")

    @keyword_only
    def __init__(self, textCol="text", idCol="doc_id", profile=None, stopWords=None, gramSource="raw"):
        super().__init__()
        self._setDefault(textCol="text", idCol="doc_id", gramSource="raw")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        self._facts_table = None
        self._facts = None

    @classmethod
    def build(
        cls, lexicons: Lexicons, profile: C.JunkProfile = C.JunkProfile(), lemmatize: bool = True, gram_source: str = "raw", text_col: str = "text", id_col: str = "doc_id"
    ) -> "TextCleaner":
        stage = cls(
            textCol=text_col, idCol=id_col, profile=asdict(profile), stopWords=list(lexicons.stop_words), gramSource=gram_source
        )
        words = C.lexicon_words(lexicons, profile)
        return stage.with_facts(C.word_facts(words, lexicons, profile, lemmatize))

    def with_facts(self, table: DataFrame, max_rows: int = FACT_ROWS) -> "TextCleaner":
        facts = collect_facts(table, max_rows)
        self._facts = facts
        self._facts_table = table
        if facts is not None:
            schema = "word string, tag string, keep boolean, lemma string, polarity double, subjectivity double"
            self._facts_table = table.sparkSession.createDataFrame([(w, *f) for w, f in facts.items()], schema)
        return self

    @property
    def joins(self) -> bool:
        return self._facts is None

    def rules(self) -> C.JunkProfile:
        return C.JunkProfile(**self.getOrDefault(self.profile))

    def _described(self, df: DataFrame) -> DataFrame:
        stop_words = self.getOrDefault(self.stopWords)
        if self._facts is not None:
            describe = facts_column(df.sparkSession, self._facts, self.rules(), stop_words)
            return df.withColumn("_facts", describe("_words"))
        if df.isStreaming:
            raise ValueError("a lexicon beyond the bound needs batches: score the stream with foreachBatch")
        # kept, so that keys are the same in both branches of the join whatever is computed again
        df = Workspace(df.sparkSession).keep(df.withColumn("_key", F.monotonically_increasing_id()), "keyed")
        tokens = df.select("_key", F.posexplode("_words").alias("pos", "word"))
        joined = lookup_join(tokens, self._facts_table, "word", "left", small=False)
        tag = F.coalesce("tag", T.suffix_tag(F.col("word")))
        keep = F.coalesce("keep", C.junk_condition(self.rules(), F.lit(False), F.lit(False), stop_words))
        lemma = F.when(keep, F.struct(F.col("pos"), F.coalesce("lemma", "word").alias("lemma")))
        grouped = joined.groupBy("_key").agg(
            F.transform(F.array_sort(F.collect_list(lemma)), lambda t: t["lemma"]).alias("lemmas"),
            *[F.count_if(tag == t).alias(t) for t in "nvaro"],
            F.coalesce(F.avg("polarity"), F.lit(0.0)).alias("polarity"),
            F.coalesce(F.avg("subjectivity"), F.lit(0.0)).alias("subjectivity"),
        )
        facts = grouped.select("_key", F.struct(*[c for c in grouped.columns if c != "_key"]).alias("_facts"))
        return df.join(facts, "_key", "left").drop("_key")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        text = self.getOrDefault(self.textCol)
        stop_words = self.getOrDefault(self.stopWords)
        df = dataset.withColumn(text, F.coalesce(F.col(text).cast("string"), F.lit("")))
        df = self._described(T.with_record_words(df, text, "_words", stop_words))
        if self.getOrDefault(self.gramSource) == "clean":
            df = T.with_corpus_words(df, text, "gram_tokens", stop_words)
        else:
            df = df.withColumn("gram_tokens", T.raw_tokens(text))
        words = F.size("_words")
        count = lambda tag: F.coalesce(F.col(f"_facts.{tag}"), F.lit(0))
        stats = R.word_stats("_words", text)
        for tag, name in R.TAG_FEATURES.items():
            stats[name] = F.when(words > 0, count(tag) / words).otherwise(F.lit(0.0))
        stats["eng__polarity_avg"] = F.coalesce("_facts.polarity", F.lit(0.0))
        stats["eng__subjectivity_avg"] = F.coalesce("_facts.subjectivity", F.lit(0.0))
        lemmas = F.coalesce("_facts.lemmas", F.array().cast("array<string>"))
        return df.withColumns({"lemmas": lemmas, **stats}).drop("_words", "_facts")

    def write(self):
        return _CleanerWriter(self)

    @classmethod
    def read(cls):
        return _CleanerReader()


class _CleanerWriter(MLWriter):
    def __init__(self, stage: TextCleaner):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        DefaultParamsWriter.saveMetadata(self.stage, path, spark)
        self.stage._facts_table.write.mode("overwrite").parquet(f"{path}/facts")


class _CleanerReader(MLReader):
    def load(self, path: str) -> TextCleaner:
        spark = SparkSession.getActiveSession()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        stage = TextCleaner()
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        return stage.with_facts(spark.read.parquet(f"{path}/facts"))
