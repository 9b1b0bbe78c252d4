
from __future__ import annotations

import importlib
import importlib.util
import os
import sys
import uuid
from collections.abc import Callable, Sequence
from functools import reduce
from operator import add

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.abspath(__file__))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

import opinionlens  # noqa: E402
from opinionlens.functions.ranking import dominant_index, sentiment_label  # noqa: E402
from opinionlens.functions.text import clean_text, join_tokens, truncate_tokens  # noqa: E402
from opinionlens.operators import emotion, explore, features, keywords, sentiment, store  # noqa: E402
from opinionlens.operators.epochs import predict as predict_epoch  # noqa: E402
from opinionlens.operators.epochs import train_epochs  # noqa: E402
from opinionlens.operators.keyed_store import KeyedStore  # noqa: E402
from opinionlens.operators.report import report_requests, search_report  # noqa: E402
from opinionlens.operators.scaling import bounded_join, with_row  # noqa: E402
from opinionlens.operators.search_index import SearchIndex  # noqa: E402
from opinionlens.operators.segment import segment  # noqa: E402
from opinionlens.operators.stopwords import stopword_filter as remove_stopwords  # noqa: E402
from opinionlens.operators.unknown_words import count_places, place_model  # noqa: E402
from opinionlens.operators.word_topics import WordTopics, fit_word_topics  # noqa: E402
from opinionlens.plans.opinion import Config, analyse  # noqa: E402
from opinionlens.session import materialize, shared_dir, spread  # noqa: E402
from opinionlens.sources import pages as html_pages  # noqa: E402
from opinionlens.sources import posts as collected  # noqa: E402
from opinionlens.sources.files import union_words  # noqa: E402
from opinionlens.streaming.overview import MaintainedOverview, rank_error  # noqa: E402

# Workers may start in another folder, where the package cannot be imported.
cloudpickle.register_pickle_by_value(opinionlens)

KEYWORD = "Tion"
ABSENT_KEYWORD = "no such words here"
# Letters that words of the documents are made of, and the share of documents a word of the partial lexicon is in.
LETTERS = "a-zß-öø-ÿœ"
LEXICON_SHARE = 0.005
SUBJECT = "health care reform"
STOP_SHARE = 0.05
# Batches in which the maintained overview gets the result table, whatever its size.
N_BATCHES = 4
# All 64 components in four blocks: a vector's weight in each of four topics.
TOPIC_BLOCKS = [range(16 * b + 1, 16 * b + 17) for b in range(4)]
# Three runs deal all components out to ten classes in different ways.
RUNS = [[[i for i in range(1, 65) if i * m % 10 == c] for c in range(10)] for m in (1, 3, 7)]
LANGS = ("en", "fr", "de", "es")

PAGE_SELECTORS = html_pages.ArticleSelectors(
    body=html_pages.Selector("article"),
    title=html_pages.Selector("title"),
    comments=html_pages.Selector("nav"),
    comment=html_pages.Selector("li"),
    comment_text=html_pages.Selector("a"),
    time=html_pages.Selector("time"),
    place=html_pages.Selector("div", "class", "ad"),
    source=html_pages.Selector("footer"),
)
ENGLISH_ONLY = html_pages.ArticleSelectors(
    body=html_pages.Selector("html", "lang", "en"), title=html_pages.Selector("title")
)


def _read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{table}.parquet")


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(_read(spark, sf, "documents").select("doc_id", "text"), "doc_id")


def _tokens(spark: SparkSession, sf: str) -> DataFrame:
    return features.tokens_of(_documents(spark, sf)).select("doc_id", "tokens")


def _benchmark_words(spark: SparkSession, sf: str) -> DataFrame:
    return features.tokens_of(_read(spark, sf, "benchmark").select("item_id", "text"))


def _stopwords(spark: SparkSession, sf: str) -> DataFrame:
    """Words found in at least 5% of the benchmark items."""
    items = _benchmark_words(spark, sf)
    n_items = _read(spark, sf, "benchmark").agg(F.count("*")).scalar()
    return features.vocabulary(items).filter(F.col("df") >= STOP_SHARE * n_items).select("word")


def _scored_events(spark: SparkSession, sf: str) -> DataFrame:
    events = _read(spark, sf, "events")
    score = F.col("value") - F.floor("value")
    return events.select(
        F.col("event_id").alias("id"), F.col("event_type").alias("dominant_topic"), score.alias("sentiment_score")
    )


def _sum_of(places: Sequence[int]) -> Column:
    """Sum of the vector's components at 1-based places, in this order."""
    return reduce(add, [F.get("embedding", F.lit(i - 1)).cast("double") for i in places])


def _topic_of_vector(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _read(spark, sf, "embeddings").withColumn("weights", F.array(*[_sum_of(b) for b in TOPIC_BLOCKS]))
    return vectors.select("vec_id", dominant_index("weights").alias("dominant_topic"), F.array_max("weights").alias("top"))


def _results(spark: SparkSession, sf: str) -> DataFrame:
    """Result table from the test data: text and keywords from the documents,
    topic from the vector and score from the event of the same number."""
    topics = _topic_of_vector(spark, sf)  # documents beyond the vectors have no topic
    scores = _scored_events(spark, sf).select(F.col("id").alias("event_id"), "sentiment_score")
    # Joined before the texts are cut: tokens and their copies as text are several times as wide.
    docs = spread(_read(spark, sf, "documents").select("doc_id", "text"), "doc_id", joined=True)
    docs = docs.join(topics, docs["doc_id"] == topics["vec_id"], "left")
    docs = docs.join(scores, docs["doc_id"] == scores["event_id"], "left")
    tokens = keywords.frequency_keywords(features.tokens_of(docs), n=3)
    score = F.round("sentiment_score", 6)
    return keywords.keyword_columns(tokens).select(
        F.col("doc_id").alias("id"),
        join_tokens("tokens", " ").alias("cut_content"),
        join_tokens("tokens", " ").alias("text"),
        "keyword1",
        "keyword2",
        "keyword3",
        F.col("tokens").alias("processed_content"),
        "dominant_topic",
        F.round("top", 6).alias("similarity_score"),
        score.alias("sentiment_score"),
        sentiment_label(score).alias("sentiment_label"),
    )


def _listed(results: DataFrame) -> DataFrame:
    """Tokens as text, and -1 for a missing topic: forms that every client shows alike."""
    return results.withColumn("processed_content", join_tokens("processed_content", " ")).na.fill(-1, ["dominant_topic"])


# --- text ---------------------------------------------------------------


def q_clean_text(spark: SparkSession, sf: str) -> DataFrame:
    return _documents(spark, sf).select("doc_id", clean_text("text").alias("cleaned_content"))


def q_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return _tokens(spark, sf).select("doc_id", F.size("tokens").alias("n"), join_tokens("tokens", "|").alias("tokens"))


def q_segment(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned text over a lexicon of the benchmark words and their counts."""
    lexicon = features.vocabulary(_benchmark_words(spark, sf)).select("word", F.col("cnt").alias("freq"))
    cleaned = _documents(spark, sf).select("doc_id", clean_text("text").alias("cleaned_content"))
    cut = segment(cleaned, lexicon)
    return cut.select("doc_id", F.size("tokens").alias("n"), join_tokens("tokens", " ").alias("cut_content"))


def q_unknown_word_places(spark: SparkSession, sf: str) -> DataFrame:
    return count_places(_tokens(spark, sf), LETTERS)


def q_segment_unknown(spark: SparkSession, sf: str) -> DataFrame:
    """Texts without their blanks, cut by a lexicon of frequent words and, where it has none, by the places of characters."""
    tokens = materialize(_tokens(spark, sf))
    n_docs = tokens.count()
    lexicon = features.vocabulary(tokens).filter(F.col("df") >= LEXICON_SHARE * n_docs).select("word", F.col("cnt").alias("freq"))
    model = place_model(count_places(tokens, LETTERS))
    run = tokens.select("doc_id", F.size("tokens").alias("n_given"), join_tokens("tokens", "").alias("cleaned_content"))
    cut = segment(spread(run, "doc_id"), lexicon, places=model, letters=LETTERS)
    return cut.select("doc_id", "n_given", F.size("tokens").alias("n"), join_tokens("tokens", " ").alias("cut_content"))


def q_stopword_union(spark: SparkSession, sf: str) -> DataFrame:
    docs = features.vocabulary(_tokens(spark, sf)).select("word")
    items = features.vocabulary(_benchmark_words(spark, sf)).select("word")
    return union_words(docs, items)


def _filtered(spark: SparkSession, sf: str) -> DataFrame:
    return remove_stopwords(_tokens(spark, sf), _stopwords(spark, sf))


def q_stopword_filter(spark: SparkSession, sf: str) -> DataFrame:
    return _filtered(spark, sf).select(
        "doc_id", F.size("filtered").alias("n"), join_tokens("filtered", "|").alias("filtered")
    )


def q_stopword_filter_joined(spark: SparkSession, sf: str) -> DataFrame:
    """The same, with the stopwords joined as a list too long for the plan would be."""
    filtered = remove_stopwords(_tokens(spark, sf), _stopwords(spark, sf), max_literal=0)
    return filtered.select("doc_id", F.size("filtered").alias("n"), join_tokens("filtered", "|").alias("filtered"))


def q_final_content(spark: SparkSession, sf: str) -> DataFrame:
    return _filtered(spark, sf).select("doc_id", join_tokens("filtered").alias("final_content"))


def q_truncate_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return _tokens(spark, sf).select("doc_id", join_tokens(truncate_tokens("tokens", 128), "|").alias("tokens"))


def q_drop_missing(spark: SparkSession, sf: str) -> DataFrame:
    docs = _read(spark, sf, "documents").select("doc_id", "text")
    labelled = docs.join(_read(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return labelled.dropna(subset=["text", "quality"]).select("doc_id", "quality")


def q_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return features.word_index(features.vocabulary(_tokens(spark, sf)))


def q_bag_of_words(spark: SparkSession, sf: str) -> DataFrame:
    return features.bag_of_words(_tokens(spark, sf))


def q_bag_word_ids(spark: SparkSession, sf: str) -> DataFrame:
    tokens = materialize(_tokens(spark, sf))
    ids = materialize(features.word_index(features.vocabulary(tokens)).select("word", "word_id"))
    bag = features.bag_of_words(tokens)
    return bounded_join(bag, ids, "word", "doc_id").select("doc_id", "word_id", "cnt")


def q_tfidf_top(spark: SparkSession, sf: str) -> DataFrame:
    return features.tfidf_top(_tokens(spark, sf), n=10, documents=_read(spark, sf, "documents"))


# --- keywords -----------------------------------------------------------


def _cosine(spark: SparkSession, sf: str, max_matrix_bytes: int = keywords.MAX_MATRIX_BYTES) -> DataFrame:
    vectors = _read(spark, sf, "embeddings")
    texts = vectors.select(F.col("vec_id").alias("doc_id"), "embedding")
    words = vectors.select(F.format_string("w%06d", "vec_id").alias("word"), "embedding")
    return keywords.cosine_topk(texts, words, 10, max_matrix_bytes=max_matrix_bytes)


def q_keyword_cosine_topk(spark: SparkSession, sf: str) -> DataFrame:
    return keywords.ranked_keywords(_cosine(spark, sf))


def q_keyword_cosine_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The same, with the words in many blocks."""
    return keywords.ranked_keywords(_cosine(spark, sf, max_matrix_bytes=1 << 16))


def q_keyword_triples(spark: SparkSession, sf: str) -> DataFrame:
    return keywords.keyword_triples(_cosine(spark, sf))


def q_word2vec_keywords(spark: SparkSession, sf: str) -> DataFrame:
    tokens = with_row(_tokens(spark, sf))
    model = keywords.fit_word2vec(tokens, size=32)
    top = keywords.cosine_topk(keywords.encode_texts(model, tokens), keywords.encode_words(model), 10)
    return keywords.keyword_triples(top)


# --- topics -------------------------------------------------------------

_MODELS: dict[tuple[str, str], tuple[DataFrame, WordTopics]] = {}


def _topics(spark: SparkSession, sf: str) -> tuple[DataFrame, WordTopics]:
    """Fit once per session and data folder; five queries read the model."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _MODELS:
        tokens = with_row(_filtered(spark, sf).select("doc_id", F.col("filtered").alias("tokens")))
        _MODELS[key] = (tokens, fit_word_topics(tokens, k=4, passes=20))
    return _MODELS[key]


def q_topic_fit(spark: SparkSession, sf: str) -> DataFrame:
    tokens, model = _topics(spark, sf)
    assigned = model.assign(tokens).select("dominant_topic", F.array_max("topic_distribution").alias("p"))
    return assigned.groupBy("dominant_topic").agg(F.count("*").alias("n_docs"), F.avg("p").alias("mean_probability"))


def q_topic_assign(spark: SparkSession, sf: str) -> DataFrame:
    tokens, model = _topics(spark, sf)
    return model.assign(tokens).select("doc_id", "dominant_topic", "topic_distribution")


def q_topic_terms(spark: SparkSession, sf: str) -> DataFrame:
    return _topics(spark, sf)[1].terms(20)


def q_topic_step(spark: SparkSession, sf: str) -> DataFrame:
    """Every word's weights after one iteration of the topic model."""
    model = fit_word_topics(materialize(_tokens(spark, sf)), k=3, passes=1, inner=1)
    return model.weights().select("word", "topic", F.round("weight", 9).alias("weight"))


def q_topic_terms_wide(spark: SparkSession, sf: str) -> DataFrame:
    return _topics(spark, sf)[1].terms_wide(20)


def q_topic_cloud_terms(spark: SparkSession, sf: str) -> DataFrame:
    return _topics(spark, sf)[1].cloud_terms(50)


def q_dominant_topic(spark: SparkSession, sf: str) -> DataFrame:
    return _topic_of_vector(spark, sf).drop("top")


# --- sentiment ----------------------------------------------------------


def q_sentiment_label(spark: SparkSession, sf: str) -> DataFrame:
    scored = _scored_events(spark, sf)
    return scored.select("id", sentiment_label(F.round("sentiment_score", 6)).alias("sentiment_label"))


def q_sentiment_by_topic(spark: SparkSession, sf: str) -> DataFrame:
    label = sentiment_label(F.round("sentiment_score", 6))
    return sentiment.sentiment_by_topic(_scored_events(spark, sf).withColumn("sentiment_label", label))


def q_sentiment_box(spark: SparkSession, sf: str) -> DataFrame:
    box = sentiment.sentiment_box(_scored_events(spark, sf))
    rounded = [F.round(c, 6).alias(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")]
    return box.select("dominant_topic", "n", *rounded, "n_outliers")


def _tail_heavy_events(spark: SparkSession, sf: str) -> DataFrame:
    return _read(spark, sf, "events").select(
        F.col("event_id").alias("id"), F.col("event_type").alias("dominant_topic"), F.col("value").alias("sentiment_score")
    )


def q_sentiment_outliers(spark: SparkSession, sf: str) -> DataFrame:
    return sentiment.sentiment_outliers(_tail_heavy_events(spark, sf))


def _nb(spark: SparkSession, sf: str) -> tuple[DataFrame, sentiment.SentimentModel]:
    tokens = with_row(_tokens(spark, sf))
    labels = _read(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    return tokens, sentiment.fit_sentiment(tokens.join(labels, "doc_id"))


def q_nb_word_weights(spark: SparkSession, sf: str) -> DataFrame:
    weights = _nb(spark, sf)[1].weights
    return weights.select("word", "pos_cnt", "neg_cnt", F.round("weight", 6).alias("weight"))


def q_sentiment_score(spark: SparkSession, sf: str) -> DataFrame:
    tokens, model = _nb(spark, sf)
    scores = model.score(tokens).select("doc_id", F.round("sentiment_score", 6).alias("sentiment_score"))
    return scores.withColumn("sentiment_label", sentiment_label("sentiment_score"))


def q_sentiment_score_joined(spark: SparkSession, sf: str) -> DataFrame:
    """The same, with weights too many to broadcast."""
    tokens, model = _nb(spark, sf)
    scores = model.score(tokens, max_broadcast=0).select("doc_id", F.round("sentiment_score", 6).alias("sentiment_score"))
    return scores.withColumn("sentiment_label", sentiment_label("sentiment_score"))


# --- exploration, store, report -----------------------------------------


def q_hot_keywords(spark: SparkSession, sf: str) -> DataFrame:
    ranked = keywords.keyword_columns(keywords.frequency_keywords(_tokens(spark, sf), n=3))
    return explore.hot_keywords(ranked)


def q_overview_comments(spark: SparkSession, sf: str) -> DataFrame:
    return explore.overview(_results(spark, sf))[0]


_OVERVIEWS: dict[tuple[str, str], tuple[DataFrame, MaintainedOverview]] = {}


def _maintained(spark: SparkSession, sf: str) -> tuple[DataFrame, MaintainedOverview]:
    """The result table as a stream of files, merged in a few batches of many files; then a replay, a snapshot and a replay of what it covers."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _OVERVIEWS:
        results = materialize(_results(spark, sf))
        if len(results.inputFiles()) < N_BATCHES:
            results = materialize(results.repartition(N_BATCHES, "id"))
        per_batch = -(-len(results.inputFiles()) // N_BATCHES)
        folder = f"{shared_dir(spark).rstrip('/')}/overview-{uuid.uuid4().hex}"
        kept = MaintainedOverview(spark, f"{folder}/state")
        files = spark.readStream.schema(results.schema).option("maxFilesPerTrigger", per_batch).parquet(os.path.dirname(results.inputFiles()[0]))
        stream = files.writeStream.foreachBatch(kept.merge).option("checkpointLocation", f"{folder}/stream")
        stream.trigger(availableNow=True).start().awaitTermination()
        kept.merge(results, 0)
        kept.compact()
        kept.merge(results, 1)
        _OVERVIEWS[key] = (results, kept)
    return _OVERVIEWS[key]


def q_hot_keywords_maintained(spark: SparkSession, sf: str) -> DataFrame:
    return _maintained(spark, sf)[1].hot_keywords()


def q_overview_comments_maintained(spark: SparkSession, sf: str) -> DataFrame:
    return _maintained(spark, sf)[1].sample_comments()


def q_sentiment_by_topic_maintained(spark: SparkSession, sf: str) -> DataFrame:
    return _maintained(spark, sf)[1].sentiment_by_topic()


def q_score_ranks_maintained(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and ends of each topic's scores, and whether the sketch's quartiles are within the bound in rank."""
    results, kept = _maintained(spark, sf)
    rows = results.filter(F.col("sentiment_score").isNotNull()).select("dominant_topic", "sentiment_score")
    score, n = F.col("sentiment_score"), F.col("n")
    close = [
        (F.count_if(score < F.col(q)) <= (p + rank_error()) * F.max(n)) & (F.count_if(score <= F.col(q)) >= (p - rank_error()) * F.max(n))
        for q, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))
    ]
    sketched = bounded_join(rows, kept.score_quantiles(), "dominant_topic", "sentiment_score").filter(n.isNotNull())
    named = [c.alias(f"{q}_close") for c, q in zip(close, ("q1", "median", "q3"), strict=True)]
    return sketched.groupBy("dominant_topic").agg(F.max(n).alias("n"), F.max("low").alias("low"), F.max("high").alias("high"), *named)


def q_search(spark: SparkSession, sf: str) -> DataFrame:
    return _listed(explore.search(_results(spark, sf), KEYWORD))


def _search_index(spark: SparkSession, sf: str) -> SearchIndex:
    index = SearchIndex(spark, f"{shared_dir(spark).rstrip('/')}/search-{uuid.uuid4().hex}")
    results = materialize(_results(spark, sf), "zstd")  # of three copies of each text
    # Two loads, as a table grows; they share a block of ids.
    half = F.pmod(F.col("id"), F.lit(2)) == 0
    index.add(results.filter(half), stored=True)
    index.add(results.filter(~half), stored=True)
    return index


def q_search_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of ``search``, read through the index."""
    return _listed(explore.search(_search_index(spark, sf).rows_for(KEYWORD), KEYWORD))


def q_search_summary_indexed(spark: SparkSession, sf: str) -> DataFrame:
    return explore.search_summary(_search_index(spark, sf).rows_for(KEYWORD), KEYWORD)


def q_search_same_topic_indexed(spark: SparkSession, sf: str) -> DataFrame:
    index = _search_index(spark, sf)
    found = explore.same_topic(index.rows(), KEYWORD, candidates=index.rows_for(KEYWORD))
    return found.select("id", "text", "dominant_topic", "sentiment_label")


def q_search_same_topic(spark: SparkSession, sf: str) -> DataFrame:
    return explore.same_topic(_results(spark, sf), KEYWORD).select("id", "text", "dominant_topic", "sentiment_label")


def q_search_summary(spark: SparkSession, sf: str) -> DataFrame:
    return explore.search_summary(_results(spark, sf), KEYWORD)


def q_search_summary_empty(spark: SparkSession, sf: str) -> DataFrame:
    return explore.search_summary(_results(spark, sf), ABSENT_KEYWORD)


def q_table_preview(spark: SparkSession, sf: str) -> DataFrame:
    return _listed(store.preview(_results(spark, sf), 5))


def q_store_append(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents are stored first, then all are loaded again."""
    docs = _read(spark, sf, "documents").select("doc_id", "source")
    labelled = docs.join(_read(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")
    none = spark.createDataFrame([], "id bigint, doc_id bigint, source string")
    stored = materialize(store.append_rows(none, labelled))
    return stored.union(store.append_rows(stored, docs))


def q_keyed_store_append(spark: SparkSession, sf: str) -> DataFrame:
    """The loads of ``store_append`` into a table with key buckets, and the first of them again."""
    docs = _read(spark, sf, "documents").select("doc_id", "source")
    labelled = docs.join(_read(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")
    table = KeyedStore(spark, f"{shared_dir(spark).rstrip('/')}/store-{uuid.uuid4().hex}", partition_by="source")
    for batch in (labelled, docs, labelled):
        table.append(batch)
    return table.rows()


def q_report_prompts(spark: SparkSession, sf: str) -> DataFrame:
    return report_requests(materialize(_results(spark, sf).na.fill(-1, ["dominant_topic"])), SUBJECT)


def q_search_report(spark: SparkSession, sf: str) -> DataFrame:
    return search_report(materialize(_results(spark, sf)), KEYWORD, SUBJECT)


# --- collection ---------------------------------------------------------


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return spread(_read(spark, sf, "pages"), "page_id")


def q_html_articles(spark: SparkSession, sf: str) -> DataFrame:
    articles, _ = html_pages.extract_articles(_pages(spark, sf), PAGE_SELECTORS)
    return articles.select(
        "page_id", "title", "time", "place", "content", "source", F.array_join("comments", "\n").alias("comments")
    )


def q_html_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return html_pages.extract_articles(_pages(spark, sf), ENGLISH_ONLY)[1]


def q_post_comment_pairs(spark: SparkSession, sf: str) -> DataFrame:
    turns = _read(spark, sf, "conversations")
    posts = turns.filter(F.col("turn") == 0).select(F.col("conv_id").alias("post_id"), F.col("text").alias("post_text"))
    comments = turns.filter(F.col("turn") > 0).select(
        F.col("conv_id").alias("post_id"), F.col("turn").alias("pos"), F.col("text").alias("comment")
    )
    return collected.post_comment_pairs(posts, comments, max_posts=None, max_comments=20)


def q_cap_per_source(spark: SparkSession, sf: str) -> DataFrame:
    docs = _read(spark, sf, "documents").select("doc_id", "source")
    return collected.cap_per_source(docs, per_page=15, max_pages=2)


def q_collect_by_keyword(spark: SparkSession, sf: str) -> DataFrame:
    return collected.collect_by_keyword(_read(spark, sf, "documents").select("doc_id", "source", "text"), "tion")


# --- emotion ------------------------------------------------------------


def _named_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Class numbers 0..7 as emotion names; the others have no known name."""
    vectors = _read(spark, sf, "embeddings").select("vec_id", F.col("label").alias("class_id"))
    named = emotion.decode_labels(vectors, "class_id", "label")
    return named.withColumn("label", F.coalesce("label", F.format_string("class%d", "class_id"))).drop("class_id")


def q_label_encode(spark: SparkSession, sf: str) -> DataFrame:
    return emotion.split_labelled(emotion.encode_labels(_named_labels(spark, sf)))[0]


def q_label_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return emotion.split_labelled(emotion.encode_labels(_named_labels(spark, sf)))[1].select("vec_id", "label")


def q_train_test_split(spark: SparkSession, sf: str) -> DataFrame:
    docs = _read(spark, sf, "documents").select("doc_id")
    train, test = emotion.train_test_split(docs)
    return train.withColumn("split", F.lit("train")).union(test.withColumn("split", F.lit("test")))


def _predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Three runs: each guesses the class by the sums of its own groups of vector components."""
    vectors = _read(spark, sf, "embeddings")
    guesses = [
        F.struct(F.lit(r).alias("run"), dominant_index(F.array(*map(_sum_of, groups))).alias("prediction"))
        for r, groups in enumerate(RUNS, 1)
    ]
    return vectors.select("vec_id", "label", F.explode(F.array(*guesses)).alias("g")).select("vec_id", "label", "g.*")


def q_emotion_metrics(spark: SparkSession, sf: str) -> DataFrame:
    metrics = emotion.classification_metrics(_predictions(spark, sf))
    return metrics.select(F.round("accuracy", 6).alias("accuracy"), F.round("f1_macro", 6).alias("f1_macro"))


def q_best_run(spark: SparkSession, sf: str) -> DataFrame:
    hit = (F.col("label") == F.col("prediction")).cast("double")
    runs = _predictions(spark, sf).groupBy("run").agg(F.round(F.avg(hit), 6).alias("accuracy"))
    return emotion.best_run(runs)


def _emotion_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents; the eight classes are language x quality."""
    docs = _read(spark, sf, "documents").select("doc_id", "text", "lang")
    labels = _read(spark, sf, "labels").select("doc_id", "quality")
    lang = F.array_position(F.array(*[F.lit(x) for x in LANGS]), F.col("lang")) - 1
    class_id = (lang * 2 + F.col("quality")).cast("int")
    # Texts are joined, not their tokens, which take several times the room in a shuffle.
    labelled = emotion.decode_labels(docs.join(labels, "doc_id").withColumn("label_id", class_id))
    return features.tokens_of(labelled).select("doc_id", "tokens", "label", "label_id")


def q_emotion_predict(spark: SparkSession, sf: str) -> DataFrame:
    train, test = emotion.train_test_split(_emotion_samples(spark, sf))
    model = emotion.fit_emotion(train)
    return emotion.predict_emotion(model, test).select("doc_id", "label", "predicted_label", "probability")


def q_emotion_epochs(spark: SparkSession, sf: str) -> DataFrame:
    samples = materialize(_emotion_samples(spark, sf))
    return train_epochs(*emotion.train_test_split(samples)).epochs


def q_emotion_best_epoch(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions of the best epoch's stored weights for the held-out documents."""
    samples = materialize(_emotion_samples(spark, sf))
    train, test = emotion.train_test_split(samples)
    said = predict_epoch(test, train_epochs(train, test).best())
    return emotion.decode_labels(said, "prediction_id", "predicted_label").select("doc_id", "label", "predicted_label")


# --- the whole chain ----------------------------------------------------


def _opinions(spark: SparkSession, sf: str, with_keywords: bool) -> DataFrame:
    comments = _documents(spark, sf).withColumnRenamed("text", "content")
    labels = _read(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    labelled = _documents(spark, sf).join(labels, "doc_id")  # before the texts are cut: the others are not stored here
    model = sentiment.fit_sentiment(materialize(features.tokens_of(labelled).select("label", "tokens")))
    results, _ = analyse(comments, model, Config(stopwords=_stopwords(spark, sf), vector_size=32, keywords=with_keywords))
    return results


def q_opinion_results(spark: SparkSession, sf: str) -> DataFrame:
    return _opinions(spark, sf, with_keywords=True)


def q_opinion_by_topic(spark: SparkSession, sf: str) -> DataFrame:
    return sentiment.sentiment_by_topic(_opinions(spark, sf, with_keywords=False))


def entry(spark: SparkSession) -> DataFrame:
    """Comments to topics to sentiment: label counts per topic."""
    return q_opinion_by_topic(spark, "/root/testdata/sf0.001")


def _corpus_part(name: str):
    """A module of the corpus operators, or None where their folder was taken out.

    The pipeline at the top is made of these operators, so it goes with them. What
    is left of the folder may still be found as a namespace without a file.
    """
    folder = importlib.util.find_spec("opinionlens.llm")
    if folder is None or folder.origin is None or importlib.util.find_spec(name) is None:
        return None
    return importlib.import_module(name)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name[2:]: fn for name, fn in globals().items() if name.startswith("q_")}
    if corpus := _corpus_part("opinionlens.llm.queries"):
        found |= corpus.QUERIES
    if pipeline := _corpus_part("corpus_pipeline"):
        found["pipeline"] = pipeline.run
    return found


# --- SQL twins ----------------------------------------------------------

_BLANK = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def _sql_clean(col: str) -> str:
    tagged = rf"regexp_replace(coalesce({col}, ''), '\[([^\]]*)R\]', '[\1]', 'g')"
    kept = rf"regexp_replace({tagged}, '[^\p{{L}}\p{{N}}_{_BLANK}\[\]]', '', 'g')"
    return rf"trim(regexp_replace(lower({kept}), '[{_BLANK}]+', ' ', 'g'))"


def _sql_tokens(table: str, key: str) -> str:
    return f"SELECT {key}, list_filter(string_split({_sql_clean('text')}, ' '), lambda x: x <> '') AS tokens FROM {table}"


_WORDS = f"""
tok AS ({_sql_tokens("documents", "doc_id")}),
words AS (SELECT doc_id, unnest(tokens) AS word FROM tok),
bag AS (SELECT doc_id, word, count(*) AS cnt FROM words GROUP BY doc_id, word)"""

_VOCAB = f"{_WORDS}, vocab AS (SELECT word, count(*) AS df, CAST(sum(cnt) AS BIGINT) AS cnt FROM bag GROUP BY word)"

_STOP = f"""
items AS ({_sql_tokens("benchmark", "item_id")}),
stop AS (
  SELECT word FROM (SELECT DISTINCT item_id, unnest(tokens) AS word FROM items)
  GROUP BY word HAVING count(*) >= {STOP_SHARE} * (SELECT count(*) FROM items)),
tok AS ({_sql_tokens("documents", "doc_id")}),
placed AS (SELECT doc_id, unnest(tokens) AS word, generate_subscripts(tokens, 1) AS i FROM tok),
kept AS (
  SELECT doc_id, list(word ORDER BY i) AS filtered FROM placed
  WHERE word NOT IN (SELECT word FROM stop) GROUP BY doc_id),
filt AS (SELECT tok.doc_id, coalesce(kept.filtered, []) AS filtered FROM tok LEFT JOIN kept USING (doc_id))"""

_LETTER_WORD = f"regexp_full_match({{}}, '[{LETTERS}]+')"
_PLACE = "CASE WHEN length(word) = 1 THEN 'S' WHEN {k} = 1 THEN 'B' WHEN {k} = length(word) THEN 'E' ELSE 'M' END"
_PLACES = f"""tok AS ({_sql_tokens("documents", "doc_id")}),
placed AS (SELECT doc_id, unnest(tokens) AS word, generate_subscripts(tokens, 1) AS i FROM tok),
led AS (SELECT word, lag(word) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM placed),
own AS (
  SELECT word, CASE WHEN {_LETTER_WORD.format("before")} THEN CASE WHEN length(before) = 1 THEN 'S' ELSE 'E' END END AS after, count(*) AS n
  FROM led WHERE {_LETTER_WORD.format("word")} GROUP BY ALL),
lettered AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM own),
found AS (
  SELECT CASE WHEN after IS NULL THEN 'start' ELSE 'step' END AS kind, coalesce(after, {_PLACE.format(k=1)}) AS place,
    CASE WHEN after IS NULL THEN '' ELSE {_PLACE.format(k=1)} END AS item, n FROM own
  UNION ALL SELECT 'step', {_PLACE.format(k="k")}, {_PLACE.format(k="(k + 1)")}, n FROM lettered WHERE k < length(word)
  UNION ALL SELECT 'char', {_PLACE.format(k="k")}, substr(word, k, 1), n FROM lettered)
SELECT kind, place, item, CAST(sum(n) AS BIGINT) AS n FROM found GROUP BY ALL"""

_TRIPLES = """
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY cnt DESC, word) AS rk FROM bag),
triples AS (
  SELECT doc_id, max(CASE WHEN rk = 1 THEN word END) AS keyword1,
    max(CASE WHEN rk = 2 THEN word END) AS keyword2, max(CASE WHEN rk = 3 THEN word END) AS keyword3
  FROM ranked WHERE rk <= 3 GROUP BY doc_id)"""


def _sql_weights(groups: Sequence[Sequence[int]]) -> str:
    return "[" + ", ".join(" + ".join(f"embedding[{i}]::DOUBLE" for i in g) for g in groups) + "]"


def _sql_argmax(part: str) -> str:
    return f"CAST(coalesce(list_position({part}, list_max({part})) - 1, 0) AS INTEGER)"


_TOPICS = f"""(SELECT vec_id, {_sql_argmax("w")} AS dominant_topic, list_max(w) AS top
  FROM (SELECT vec_id, {_sql_weights(TOPIC_BLOCKS)} AS w FROM embeddings))"""


def _sql_label(score: str) -> str:
    return f"CASE WHEN {score} >= 0.6 THEN 'Positive' WHEN {score} <= 0.4 THEN 'Negative' ELSE 'Neutral' END"


_RESULTS = f"""{_WORDS}, {_TRIPLES},
results AS (
  SELECT tok.doc_id AS id, array_to_string(tokens, ' ') AS cut_content, array_to_string(tokens, ' ') AS text,
    keyword1, keyword2, keyword3,
    array_to_string(tokens, ' ') AS processed_content, t.dominant_topic, round(t.top, 6) AS similarity_score,
    round(s.score, 6) AS sentiment_score, {_sql_label("round(s.score, 6)")} AS sentiment_label
  FROM tok LEFT JOIN triples USING (doc_id)
  LEFT JOIN {_TOPICS} t ON t.vec_id = tok.doc_id
  LEFT JOIN (SELECT event_id, value - floor(value) AS score FROM events) s ON s.event_id = tok.doc_id)"""


_LISTED = "listed_results AS (SELECT * REPLACE (coalesce(dominant_topic, -1) AS dominant_topic) FROM results)"


def _sql_fold(col: str) -> str:
    return f"translate({col}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _sql_hit(keyword: str) -> str:
    cols = ("text", "keyword1", "keyword2", "keyword3")
    return "(" + " OR ".join(f"{_sql_fold(c)} LIKE '%{keyword.lower()}%'" for c in cols) + ")"


def _sql_summary(keyword: str) -> str:
    return f"""WITH {_RESULTS}, c AS (
      SELECT count(*) AS total_comments, count(*) FILTER (sentiment_label = 'Positive') AS positive,
        count(*) FILTER (sentiment_label = 'Neutral') AS neutral,
        count(*) FILTER (sentiment_label = 'Negative') AS negative
      FROM results WHERE {_sql_hit(keyword)})
    SELECT *, CASE WHEN total_comments > 0 THEN
      '搜索关键词 ''{keyword}'' 共找到 ' || total_comments || ' 条评论，其中正面评论 ' || positive ||
      ' 条，中性评论 ' || neutral || ' 条，负面评论 ' || negative || ' 条。'
      ELSE '未找到与关键词 ''{keyword}'' 相关的评论。' END AS api_summary FROM c"""


_EVENTS = """ev AS (
  SELECT event_id AS id, event_type AS dominant_topic, value - floor(value) AS sentiment_score, value FROM events)"""

_PAIRS = """
vecs AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
sims AS (
  SELECT a.vec_id AS doc_id, printf('w%06d', b.vec_id) AS keyword,
    round(list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))), 6) AS similarity
  FROM vecs a, vecs b),
top AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY similarity DESC, keyword) AS rank FROM sims
  QUALIFY rank <= 10)"""

_NB = f"""{_WORDS},
counts AS (
  SELECT word, CAST(sum(CASE WHEN quality = 1 THEN cnt ELSE 0 END) AS BIGINT) AS pos_cnt,
    CAST(sum(CASE WHEN quality = 1 THEN 0 ELSE cnt END) AS BIGINT) AS neg_cnt
  FROM bag JOIN labels USING (doc_id) GROUP BY word),
tot AS (
  SELECT sum(pos_cnt) + count(*) AS p, sum(neg_cnt) + count(*) AS n FROM counts),
prior AS (
  SELECT ln(count(*) FILTER (quality = 1)::DOUBLE / count(*) FILTER (quality <> 1)) AS prior
  FROM labels JOIN documents USING (doc_id)),
weights AS (
  SELECT word, pos_cnt, neg_cnt,
    ln((pos_cnt + 1)::DOUBLE / p) - ln((neg_cnt + 1)::DOUBLE / n) AS weight FROM counts, tot)"""

# An HTML reader takes "&amp" without its semicolon too.
_ENTITIES = (
    "regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'),"
    " '&quot;', '\"'), '&apos;', ''''), '&#39;', ''''), '&nbsp;', chr(160)), '&copy;', '©'), '&middot;', '·'), '&amp;?', '&', 'g')"
)
_MARKUP = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|</?[a-z][^>]*>|<![^>]*>"


def _sql_text(markup: str, joiner: str) -> str:
    marked = f"regexp_replace({markup}, '{_MARKUP}', chr(1), 'g')"
    plain = _ENTITIES.replace("{x}", marked)
    if joiner:
        spaced = f"regexp_replace({plain}, '\\x01+', {joiner}, 'g')"
    else:
        spaced = f"regexp_replace({plain}, '[{_BLANK}]*\\x01[{_BLANK}\\x01]*', '', 'g')"
    return f"regexp_replace({spaced}, '^[{_BLANK}]+|[{_BLANK}]+$', '', 'g')"


def _sql_inner(tag: str, attributes: str = "") -> str:
    return f"nullif(regexp_extract(html, '(?s)<{tag}{attributes}>(.*?)(</{tag}>|$)', 1), '')"


_SECTIONS = "chr(10) || chr(10) || '格式要求：' || chr(10) || '一、主题分布' || chr(10) || '二、主题关联性分析' || chr(10) || '三、政策舆情分析与解读' || chr(10)"


def _sql_requests(rows: str, group: str, order: str) -> str:
    return f"""
placed AS (
  SELECT {group}, text, row_number() OVER (PARTITION BY {group} ORDER BY {order}) - 1 AS i FROM {rows} WHERE trim(text) <> ''),
parts AS (
  SELECT {group}, i // 100 + 1 AS part, count(*) AS n_comments, list(trim(text) ORDER BY i) AS c
  FROM placed GROUP BY {group}, i // 100 + 1),
prompts AS (
  SELECT {group}, part, n_comments, chr(10) || '结合{SUBJECT}的具体政策条例辅助分析，针对以下用户评论，进行结构化主题分析：'
    || chr(10) || '评论列表：' || chr(10) || CAST(to_json(c) AS VARCHAR) || {_SECTIONS} AS prompt FROM parts),
requests AS (
  SELECT *, '{{"model":"glm-4","messages":[{{"role":"user","content":' || CAST(to_json(prompt) AS VARCHAR)
    || '}}],"temperature":0.7,"top_p":0.95,"max_tokens":1500}}' AS payload FROM prompts)"""


# Queries that force an operator's way for large inputs, and the query whose result they must give.
SAME_RESULT = {
    "keyword_cosine_blocks": "keyword_cosine_topk",
    "stopword_filter_joined": "stopword_filter",
    "sentiment_score_joined": "sentiment_score",
    "hot_keywords_maintained": "hot_keywords",
    "overview_comments_maintained": "overview_comments",
    "keyed_store_append": "store_append",
    "search_indexed": "search",
    "search_summary_indexed": "search_summary",
    "search_same_topic_indexed": "search_same_topic",
}


def oracle_sql() -> dict[str, str]:
    found = _own_sql()
    found |= {name: found[other] for name, other in SAME_RESULT.items()}
    if corpus := _corpus_part("opinionlens.llm.queries"):
        found |= corpus.ORACLES
    if (pipeline := _corpus_part("corpus_pipeline")) and pipeline.ORACLE_SQL:
        found["pipeline"] = pipeline.ORACLE_SQL
    return found


def _own_sql() -> dict[str, str]:
    return {
        "clean_text": f"SELECT doc_id, {_sql_clean('text')} AS cleaned_content FROM documents",
        "tokens": f"""WITH tok AS ({_sql_tokens("documents", "doc_id")})
            SELECT doc_id, CAST(len(tokens) AS INTEGER) AS n, array_to_string(tokens, '|') AS tokens FROM tok""",
        "segment": f"""WITH tok AS ({_sql_tokens("documents", "doc_id")})
            SELECT doc_id, CAST(len(tokens) AS INTEGER) AS n, array_to_string(tokens, ' ') AS cut_content FROM tok""",
        "unknown_word_places": f"""WITH {_PLACES}""",
        "stopword_union": f"""WITH a AS ({_sql_tokens("documents", "doc_id")}), b AS ({_sql_tokens("benchmark", "item_id")})
            SELECT unnest(tokens) AS word FROM a UNION SELECT unnest(tokens) AS word FROM b""",
        "stopword_filter": f"""WITH {_STOP}
            SELECT doc_id, CAST(len(filtered) AS INTEGER) AS n, array_to_string(filtered, '|') AS filtered FROM filt""",
        "final_content": f"WITH {_STOP} SELECT doc_id, array_to_string(filtered, '') AS final_content FROM filt",
        "truncate_tokens": f"""WITH tok AS ({_sql_tokens("documents", "doc_id")})
            SELECT doc_id, array_to_string(list_slice(tokens, 1, 128), '|') AS tokens FROM tok""",
        "drop_missing": """SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id)
            WHERE text IS NOT NULL AND quality IS NOT NULL""",
        "vocabulary": f"""WITH {_VOCAB}
            SELECT row_number() OVER (ORDER BY word) - 1 AS word_id, word, df, cnt FROM vocab""",
        "bag_of_words": f"WITH {_WORDS} SELECT doc_id, word, cnt FROM bag",
        "bag_word_ids": f"""WITH {_VOCAB}, ids AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS word_id FROM vocab)
            SELECT doc_id, word_id, bag.cnt AS cnt FROM bag JOIN ids USING (word)""",
        "tfidf_top": f"""WITH {_VOCAB}
            SELECT word AS keyword,
              round(cnt * (ln((1 + (SELECT count(*) FROM documents))::DOUBLE / (1 + df)) + 1), 6) AS tfidf_weight
            FROM vocab ORDER BY tfidf_weight DESC, keyword LIMIT 10""",
        "keyword_cosine_topk": f"""WITH {_PAIRS}
            SELECT doc_id, CAST(rank AS INTEGER) AS rank, keyword, similarity FROM top""",
        "keyword_triples": f"""WITH {_PAIRS}
            SELECT doc_id, max(CASE WHEN rank = 1 THEN keyword END) AS keyword1,
              max(CASE WHEN rank = 2 THEN keyword END) AS keyword2, max(CASE WHEN rank = 3 THEN keyword END) AS keyword3,
              max(CASE WHEN rank = 1 THEN similarity END) AS similarity_score FROM top GROUP BY doc_id""",
        "topic_step": _sql_topic_step(),
        "dominant_topic": f"SELECT vec_id, dominant_topic FROM {_TOPICS}",
        "sentiment_label": f"""WITH {_EVENTS}
            SELECT id, {_sql_label("round(sentiment_score, 6)")} AS sentiment_label FROM ev""",
        "sentiment_by_topic": f"""WITH {_EVENTS},
            l AS (SELECT dominant_topic, {_sql_label("round(sentiment_score, 6)")} AS label FROM ev)
            SELECT dominant_topic, count(*) FILTER (label = 'Negative') AS Negative,
              count(*) FILTER (label = 'Neutral') AS Neutral, count(*) FILTER (label = 'Positive') AS Positive
            FROM l GROUP BY dominant_topic""",
        "sentiment_box": f"""WITH {_EVENTS},
            q AS (SELECT dominant_topic, count(*) AS n, quantile_cont(sentiment_score, 0.25) AS q1,
              quantile_cont(sentiment_score, 0.5) AS median, quantile_cont(sentiment_score, 0.75) AS q3
              FROM ev GROUP BY dominant_topic),
            f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
            SELECT dominant_topic, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
              round(min(sentiment_score) FILTER (sentiment_score BETWEEN lo AND hi), 6) AS whisker_low,
              round(max(sentiment_score) FILTER (sentiment_score BETWEEN lo AND hi), 6) AS whisker_high,
              count(*) FILTER (sentiment_score < lo OR sentiment_score > hi) AS n_outliers
            FROM ev JOIN f USING (dominant_topic) GROUP BY dominant_topic, n, q1, median, q3""",
        "sentiment_outliers": """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1,
              quantile_cont(value, 0.75) AS q3 FROM events GROUP BY event_type)
            SELECT event_id AS id, event_type AS dominant_topic, value AS sentiment_score
            FROM events JOIN q USING (event_type)
            WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""",
        "nb_word_weights": f"WITH {_NB} SELECT word, pos_cnt, neg_cnt, round(weight, 6) AS weight FROM weights",
        "sentiment_score": f"""WITH {_NB},
            odds AS (SELECT doc_id, any_value(prior) + coalesce(sum(cnt * coalesce(weight, ln(n::DOUBLE / p))), 0) AS o
              FROM tok LEFT JOIN bag USING (doc_id) LEFT JOIN weights USING (word), prior, tot GROUP BY doc_id),
            s AS (SELECT doc_id, round(1 / (1 + exp(-greatest(-700, least(700, o)))), 6) AS sentiment_score FROM odds)
            SELECT doc_id, sentiment_score, {_sql_label("sentiment_score")} AS sentiment_label FROM s""",
        "hot_keywords": f"""WITH {_WORDS}, {_TRIPLES},
            t AS (SELECT tok.doc_id, keyword1, keyword2, keyword3 FROM tok LEFT JOIN triples USING (doc_id)),
            u AS (SELECT keyword1 AS keyword FROM t UNION ALL SELECT keyword2 FROM t UNION ALL SELECT keyword3 FROM t)
            SELECT keyword, count(*) AS count FROM u GROUP BY keyword
            ORDER BY count DESC, keyword ASC NULLS LAST LIMIT 20""",
        "overview_comments": f"WITH {_RESULTS} SELECT id, cut_content FROM results ORDER BY id LIMIT 10",
        "sentiment_by_topic_maintained": f"""WITH {_RESULTS}
            SELECT dominant_topic, count(*) FILTER (sentiment_label = 'Negative') AS Negative,
              count(*) FILTER (sentiment_label = 'Neutral') AS Neutral, count(*) FILTER (sentiment_label = 'Positive') AS Positive
            FROM results WHERE dominant_topic IS NOT NULL GROUP BY dominant_topic""",
        "score_ranks_maintained": f"""WITH {_RESULTS}
            SELECT dominant_topic, count(*) AS n, min(sentiment_score) AS low, max(sentiment_score) AS high,
              true AS q1_close, true AS median_close, true AS q3_close
            FROM results WHERE dominant_topic IS NOT NULL AND sentiment_score IS NOT NULL GROUP BY dominant_topic""",
        "search": f"WITH {_RESULTS}, {_LISTED} SELECT {', '.join(explore.RESULT_COLUMNS)} FROM listed_results WHERE {_sql_hit(KEYWORD)}",
        "search_same_topic": f"""WITH {_RESULTS},
            first_hit AS (SELECT dominant_topic FROM results WHERE {_sql_hit(KEYWORD)} ORDER BY id LIMIT 1)
            SELECT id, text, dominant_topic, sentiment_label FROM results
            WHERE dominant_topic = (SELECT dominant_topic FROM first_hit)""",
        "search_summary": _sql_summary(KEYWORD),
        "search_summary_empty": _sql_summary(ABSENT_KEYWORD),
        "table_preview": f"WITH {_RESULTS}, {_LISTED} SELECT * FROM listed_results ORDER BY id LIMIT 5",
        "store_append": """WITH l AS (SELECT doc_id FROM labels),
            a AS (SELECT row_number() OVER (ORDER BY doc_id) AS id, doc_id, source FROM documents
              WHERE doc_id IN (SELECT doc_id FROM l)),
            b AS (SELECT (SELECT count(*) FROM a) + row_number() OVER (ORDER BY doc_id) AS id, doc_id, source
              FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM l))
            SELECT * FROM a UNION ALL SELECT * FROM b""",
        "report_prompts": f"""WITH {_RESULTS}, {_LISTED}, {_sql_requests("listed_results", "dominant_topic", "id")}
            SELECT dominant_topic, part, n_comments, prompt, payload FROM requests""",
        "search_report": f"""WITH {_RESULTS},
            first_hit AS (SELECT dominant_topic FROM results WHERE {_sql_hit(KEYWORD)} ORDER BY id LIMIT 1),
            listed AS (
              SELECT '{KEYWORD}' AS keyword, 0 AS section, id, text FROM results WHERE {_sql_hit(KEYWORD)}
              UNION ALL SELECT '{KEYWORD}', 1, id, text FROM results
              WHERE dominant_topic = (SELECT dominant_topic FROM first_hit)),
            {_sql_requests("listed", "keyword", "section, id")}
            SELECT keyword, part, n_comments, prompt, payload FROM requests""",
        "html_articles": f"""SELECT page_id, {_sql_text(_sql_inner("title"), "")} AS title, 'N/A' AS time,
              coalesce({_sql_text(_sql_inner("div", ' class="ad"'), "")}, 'N/A') AS place,
              {_sql_text(_sql_inner("article"), "chr(10)")} AS content,
              coalesce({_sql_text(_sql_inner("footer"), "")}, 'N/A') AS source,
              array_to_string(list_transform(regexp_extract_all(html, '(?s)<li><a [^>]*>(.*?)</a></li>', 1),
                lambda x: {_sql_text("x", "")}), chr(10)) AS comments
            FROM pages""",
        "html_rejects": """SELECT page_id, url, 'no body' AS reason FROM pages
            WHERE NOT regexp_matches(html, '<html lang="en"')""",
        "post_comment_pairs": """SELECT p.conv_id AS post_id, p.text AS post_text, c.turn AS pos, c.text AS comment
            FROM conversations p JOIN (
              SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rk FROM conversations WHERE turn > 0) c
            ON p.conv_id = c.conv_id WHERE p.turn = 0 AND rk <= 20""",
        "cap_per_source": """WITH r AS (SELECT doc_id, source,
              row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rk FROM documents)
            SELECT doc_id, source, CAST((rk - 1) // 15 + 1 AS INTEGER) AS page, CAST((rk - 1) % 15 + 1 AS INTEGER) AS place
            FROM r WHERE rk <= 30""",
        "collect_by_keyword": "SELECT doc_id, source, text FROM documents WHERE contains(text, 'tion')",
        "label_encode": f"""WITH e AS (SELECT vec_id, label AS class_id FROM embeddings)
            SELECT vec_id, {_sql_names("class_id")} AS label, CAST(class_id AS INTEGER) AS label_id FROM e
            WHERE class_id < 8""",
        "label_rejects": """SELECT vec_id, 'class' || label AS label FROM embeddings WHERE label >= 8""",
        "train_test_split": f"""SELECT doc_id, CASE WHEN ((doc_id % {emotion.SPLIT_SPACE}) * {emotion.SPLIT_FACTOR}) % {emotion.SPLIT_SPACE}
            < {int(0.1 * emotion.SPLIT_SPACE)} THEN 'test' ELSE 'train' END AS split FROM documents""",
        "emotion_metrics": f"""WITH {_sql_runs()},
            cls AS (SELECT label AS c FROM pred UNION SELECT prediction FROM pred),
            f AS (SELECT c, (SELECT count(*) FROM pred WHERE label = c AND prediction = c) AS tp,
              (SELECT count(*) FROM pred WHERE label = c) AS actual, (SELECT count(*) FROM pred WHERE prediction = c) AS said
              FROM cls)
            SELECT round((SELECT avg(CASE WHEN label = prediction THEN 1.0::DOUBLE ELSE 0 END) FROM pred), 6) AS accuracy,
              round(avg(2.0::DOUBLE * tp / (actual + said)), 6) AS f1_macro FROM f""",
        "best_run": f"""WITH {_sql_runs()}
            SELECT run, round(avg(CASE WHEN label = prediction THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy
            FROM pred GROUP BY run ORDER BY accuracy DESC, run LIMIT 1""",
    }


def _sql_topic_step() -> str:
    """One update of the texts' topics and one of the words', for three topics."""
    shares = ", ".join(f"0.5 + ('0x' || substr(md5(word || ':{t}'), 1, 4))::INTEGER / 65536.0::DOUBLE AS s{t}" for t in range(3))
    total = "(s0 + s1 + s2)"
    start = ", ".join(f"cnt * s{t} / {total} AS n{t}" for t in range(3))
    third, n_words = "(1.0::DOUBLE / 3)", "(SELECT count(*) FROM vocab)"
    likely = ", ".join(f"(n{t} + {third}) / ((SELECT sum(n{t}) FROM started) + {n_words} * {third}) AS p{t}" for t in range(3))
    mixed = ", ".join(f"bag.cnt * (n / 3 + {third}) * p{t} / ((n / 3 + {third}) * (p0 + p1 + p2)) AS c{t}" for t in range(3))
    again = " + ".join(f"(t{t} + {third}) * p{t}" for t in range(3))
    words = ", ".join(f"sum(bag.cnt * (t{t} + {third}) * p{t} / ({again})) AS w{t}" for t in range(3))
    out = " UNION ALL ".join(
        f"SELECT word, {t} AS topic, round((w{t} + {third}) / ((SELECT sum(w{t}) FROM new) + {n_words} * {third}), 9) AS weight FROM new" for t in range(3)
    )
    return f"""WITH {_VOCAB}, shared AS (SELECT word, cnt, {shares} FROM vocab), started AS (SELECT word, {start} FROM shared),
        likely AS MATERIALIZED (SELECT word, {likely} FROM started), sizes AS (SELECT doc_id, sum(cnt)::DOUBLE AS n FROM bag GROUP BY doc_id),
        mixed AS (SELECT doc_id, {mixed} FROM bag JOIN likely USING (word) JOIN sizes USING (doc_id)),
        theta AS MATERIALIZED (SELECT doc_id, sum(c0) AS t0, sum(c1) AS t1, sum(c2) AS t2 FROM mixed GROUP BY doc_id),
        new AS MATERIALIZED (SELECT word, {words} FROM bag JOIN likely USING (word) JOIN theta USING (doc_id) GROUP BY word)
        SELECT word, topic::INTEGER AS topic, weight FROM ({out})"""


def _sql_names(class_id: str) -> str:
    names = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(emotion.EMOTIONS))
    return f"CASE {class_id} {names} ELSE 'class' || {class_id} END"


def _sql_runs() -> str:
    runs = " UNION ALL ".join(
        f"SELECT vec_id, label, {r} AS run, {_sql_argmax('w')} AS prediction"
        f" FROM (SELECT vec_id, label, {_sql_weights(groups)} AS w FROM embeddings)"
        for r, groups in enumerate(RUNS, 1)
    )
    return f"pred AS ({runs})"
