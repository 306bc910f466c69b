"""The registered queries: each takes (spark, sf_dir) and runs over whole tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenlake.functions import chars
from tokenlake.functions.text import END_OF_TEXT
from tokenlake.operators import bpe, codec, dataset, dictionary, ngram, pretoken, stats, trainer, vectors
from tokenlake.operators.tokenizer import N_BYTES, Tokenizer, vocab_stats
from tokenlake.sources import corpus, tokenizer_io
from tokenlake.sources.token_store import TokenStore, open_store, write_store
from tokenlake.sources.job_checkpoint import JobCheckpoint
from tokenlake.streaming import corpus as streaming
from tokenlake.workspace import Workspace, hadoop_path

Query = Callable[[SparkSession, str], DataFrame]

SPECIALS = (END_OF_TEXT,)
LONG_SPECIAL = END_OF_TEXT + "<|sep|>"
N_MERGES = 60
VOCAB_SIZE = N_BYTES + len(SPECIALS) + N_MERGES
WINDOW = 32
SEED = 7
ALPHA = 1.0
STEPS = 3
STOP_TOKEN = ord(".")
PROJECTED_COLUMNS = 1024
DOCUMENTS_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

SINGLE_RUN = (trainer.Run(0, lr=0.05, batch_size=16),)
# The sweep over learning rates and the sweep over batch sizes.
SWEEP = tuple(
    [trainer.Run(i, lr=lr, batch_size=8) for i, lr in enumerate((1e-4, 5e-4, 2e-3))]
    + [trainer.Run(3 + i, lr=5e-4, batch_size=size) for i, size in enumerate((4, 16, 64))]
)

_TABLES: dict[tuple[str, str, str], object] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    columns = columns or ("doc_id", "text")
    return corpus.scan_corpus(spark, f"{sf_dir}/documents.parquet", columns, spread_by="doc_id")


def tokenizer(spark: SparkSession, sf_dir: str) -> Tokenizer:
    """Trained on all documents, once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, "tokenizer")
    if key not in _TABLES:
        _TABLES[key] = bpe.train_bpe(documents(spark, sf_dir), VOCAB_SIZE, SPECIALS)
    return _TABLES[key]


def encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, lang, ids, n_tokens) of all documents, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, "encoded")
    path = _TABLES.get(key)
    if path is not None:
        fs, folder = hadoop_path(spark, f"{path}/_SUCCESS")
        if fs.exists(folder):
            return spark.read.parquet(path)
    workspace = Workspace(spark, "encoded")
    table = workspace.save(
        codec.encode(documents(spark, sf_dir, "doc_id", "text", "lang"), tokenizer(spark, sf_dir), keep=("doc_id", "lang")),
        "encoded",
    )
    _TABLES[key] = f"{workspace.path}/encoded"
    return table


def token_store(spark: SparkSession, sf_dir: str) -> TokenStore:
    """The encoded documents as a packed stream, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, "store")
    path = _TABLES.get(key)
    if path is not None:
        fs, folder = hadoop_path(spark, f"{path}/manifest/_SUCCESS")
        if fs.exists(folder):
            return open_store(spark, path)
    _TABLES[key] = Workspace(spark, "store").path
    return write_store(encoded(spark, sf_dir), _TABLES[key])


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pretoken.word_table(pretoken.pretoken_freq(documents(spark, sf_dir), specials=SPECIALS))


def _comma(ids: Column) -> Column:
    return F.array_join(ids.cast("array<string>"), ",")


def _merges(tok: Tokenizer, spark: SparkSession) -> DataFrame:
    return tok.merges_table(spark)


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations with both specials put into the text."""
    text = F.replace(F.col("text"), F.lit("\n"), F.lit(LONG_SPECIAL))
    text = F.replace(text, F.lit(". "), F.lit("." + END_OF_TEXT))
    return _table(spark, sf_dir, "conversations").select("conv_id", "turn", text.alias("text"))


# Sources


def scan_corpus(spark, sf_dir):
    docs = corpus.scan_corpus(spark, f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", "lang", "source", F.octet_length("text").cast("bigint").alias("n_bytes"))


def byte_budget(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    half = docs.agg(F.sum(F.octet_length("text"))).first()[0] // 2
    return corpus.byte_budget(docs, half).select("doc_id", F.col("kept_bytes").cast("bigint").alias("kept_bytes"), "text")


def split_documents(spark, sf_dir):
    docs = documents(spark, sf_dir)
    marked = docs.withColumn("text", F.replace(F.col("text"), F.lit("\n"), F.lit(END_OF_TEXT)))
    return corpus.split_documents(marked, keep=("doc_id",))


def train_valid_split(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id")
    return corpus.train_valid_split(docs)


def pack_token_ids(spark, sf_dir):
    packed = corpus.pack_token_ids(encoded(spark, sf_dir), width_bits=16)
    return packed.select("doc_id", "n_tokens", "max_id", "width_bits")


def tokenizer_save_load(spark, sf_dir):
    workspace = Workspace(spark, "tokenizer")
    tokenizer_io.save_json(spark, tokenizer(spark, sf_dir), f"{workspace.path}/json")
    from_json = tokenizer_io.load_json(spark, f"{workspace.path}/json")
    tokenizer_io.save_tables(spark, from_json, f"{workspace.path}/tables")
    loaded = tokenizer_io.load_tables(spark, f"{workspace.path}/tables")
    return _merges(loaded, spark).select("rank", "a", "b", "new_id")


def job_checkpoint(spark, sf_dir):
    """Training that is broken off half way and goes on from its saved state."""
    states = JobCheckpoint(spark, Workspace(spark, "checkpoint").path)
    first = N_BYTES + len(SPECIALS)
    bpe.train_bpe_words(words(spark, sf_dir), N_MERGES // 2, first, checkpoint=states, save_every=10)
    merges = bpe.train_bpe_words(words(spark, sf_dir), N_MERGES, first, checkpoint=states, save_every=10)
    return _merges(Tokenizer(tuple(merges), SPECIALS), spark)


# Text


def strip_specials(spark, sf_dir):
    return pretoken.strip_specials(_marked(spark, sf_dir), (LONG_SPECIAL, END_OF_TEXT))


def split_specials(spark, sf_dir):
    return pretoken.split_specials(_marked(spark, sf_dir), (END_OF_TEXT, LONG_SPECIAL), keep=("conv_id", "turn"))


def pretokenize(spark, sf_dir):
    return pretoken.pretokenize(documents(spark, sf_dir))


def pretokenize_pages(spark, sf_dir):
    pages = corpus.scan_corpus(spark, f"{sf_dir}/pages.parquet", ("page_id", "html"), spread_by="page_id")
    return pretoken.pretokenize(pages, "html", ("page_id",))


def utf8_byte_ids(spark, sf_dir):
    table = pretoken.utf8_byte_ids(_table(spark, sf_dir, "benchmark"), keep=("item_id",))
    return table.select("item_id", _comma(F.col("ids")).alias("ids"))


def next_token_pairs(spark, sf_dir):
    return dataset.next_token_pairs(encoded(spark, sf_dir))


# Vocabulary


def pretoken_freq(spark, sf_dir):
    return pretoken.pretoken_freq(documents(spark, sf_dir), specials=SPECIALS)


def pair_counts(spark, sf_dir):
    return bpe.pair_counts(words(spark, sf_dir))


def best_pair(spark, sf_dir):
    return bpe.best_pair(pair_counts(spark, sf_dir))


def _first_pair(table: DataFrame) -> tuple[int, int]:
    top = bpe.best_pair(bpe.pair_counts(table)).first()
    return top["a"], top["b"]


def apply_merge(spark, sf_dir):
    table = Workspace(spark, "words").save(words(spark, sf_dir), "words")
    merged = bpe.apply_merge(table, *_first_pair(table), N_BYTES + len(SPECIALS))
    return merged.select(
        _comma(chars.ids(F.col("word"))).alias("before"), _comma(chars.ids(F.col("merged"))).alias("after"), "freq"
    )


def pair_count_delta(spark, sf_dir):
    table = Workspace(spark, "words").save(words(spark, sf_dir), "words")
    return bpe.pair_count_delta(table, bpe.pair_counts(table), *_first_pair(table), N_BYTES + len(SPECIALS))


def train_bpe(spark, sf_dir):
    return _merges(bpe.train_bpe(documents(spark, sf_dir), VOCAB_SIZE, SPECIALS), spark)


def build_vocab(spark, sf_dir):
    return tokenizer(spark, sf_dir).vocab_table(spark).select(
        "token_id", F.hex("token").alias("token"), F.octet_length("token").alias("n_bytes"), "kind"
    )


def vocab_statistics(spark, sf_dir):
    return vocab_stats(tokenizer(spark, sf_dir).vocab_table(spark)).withColumn("longest_token", F.hex("longest_token"))


# Encoding and statistics


def encode(spark, sf_dir):
    coded = codec.encode(documents(spark, sf_dir), tokenizer(spark, sf_dir))
    return coded.select("doc_id", _comma(F.col("ids")).alias("ids"), "n_tokens")


def encode_by_dictionary(spark, sf_dir):
    """Conversations fill a dictionary, documents add their words to it and are encoded by it."""
    held = dictionary.WordDictionary(spark, f"{Workspace(spark, 'words').path}/dictionary", tokenizer(spark, sf_dir))
    dictionary.encode_by_dictionary(_table(spark, sf_dir, "conversations"), held, keep=("conv_id", "turn"))
    coded = dictionary.encode_by_dictionary(documents(spark, sf_dir), held)
    return coded.select("doc_id", _comma(F.col("ids")).alias("ids"), "n_tokens")


def encode_conversations(spark, sf_dir):
    """Turns with specials inside the text."""
    coded = codec.encode(_marked(spark, sf_dir), tokenizer(spark, sf_dir), keep=("conv_id", "turn"))
    return coded.select("conv_id", "turn", _comma(F.col("ids")).alias("ids"), "n_tokens")


def decode(spark, sf_dir):
    return codec.decode(encoded(spark, sf_dir), tokenizer(spark, sf_dir))


def roundtrip_check(spark, sf_dir):
    return codec.roundtrip_check(documents(spark, sf_dir), tokenizer(spark, sf_dir))


def roundtrip_check_pages(spark, sf_dir):
    pages = corpus.scan_corpus(spark, f"{sf_dir}/pages.parquet", ("page_id", "html"), spread_by="page_id")
    return codec.roundtrip_check(pages, tokenizer(spark, sf_dir), "html", "page_id")


def sample_docs(spark, sf_dir):
    return stats.sample_docs(_table(spark, sf_dir, "documents").select("doc_id", "text"), 10)


def compression_ratio(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    report = stats.compression_ratio(docs, tokenizer(spark, sf_dir), ("lang",))
    return report.withColumn("ratio", F.round("ratio", 6))


def throughput_report(spark, sf_dir):
    return stats.throughput_report(documents(spark, sf_dir), tokenizer(spark, sf_dir))


# Token datasets


def token_stream(spark, sf_dir):
    return token_store(spark, sf_dir).stream()


def token_store_documents(spark, sf_dir):
    """Documents unpacked from the store, as they were encoded."""
    return token_store(spark, sf_dir).documents().select("doc_id", _comma(F.col("ids")).alias("ids"), "n_tokens")


def _windows(spark, sf_dir) -> DataFrame:
    return token_store(spark, sf_dir).sample_windows(64, WINDOW, SEED)


def sample_windows(spark, sf_dir):
    return _windows(spark, sf_dir).select("sample_id", "start", _comma(F.col("tokens")).alias("tokens"))


def window_pairs(spark, sf_dir):
    """Contexts and targets of the sampled windows: a window of L gives L - 1."""
    return dataset.next_token_pairs(_windows(spark, sf_dir), ("sample_id",), "tokens")


def window_loss(spark, sf_dir):
    """The loss of the sampled windows, per window, under the counts of the training split."""
    pairs = ngram.context_pairs(_windows(spark, sf_dir), 1, ("sample_id",), "tokens")
    report = ngram.perplexity(pairs, _model(spark, sf_dir), VOCAB_SIZE, ("sample_id",), ALPHA)
    return report.withColumn("ppl", F.round("ppl", 6))


# Next-token model


def _split_pairs(spark, sf_dir, split: str, order: int = 1) -> DataFrame:
    """Context pairs of one split, read from the written token table."""
    table = corpus.train_valid_split(encoded(spark, sf_dir)).filter(F.col("split") == split)
    return ngram.context_pairs(table, order, ("doc_id", "lang"))


def _model(spark, sf_dir) -> DataFrame:
    counts = ngram.fit_ngram(_split_pairs(spark, sf_dir, "train"))
    return Workspace(spark, "ngram").save(counts, "counts")


def _logits(spark, sf_dir) -> DataFrame:
    return _model(spark, sf_dir).withColumn("logit", F.log("cnt"))


def fit_ngram(spark, sf_dir):
    return ngram.fit_ngram(_split_pairs(spark, sf_dir, "train"))


def fit_ngram_order2(spark, sf_dir):
    return ngram.fit_ngram(_split_pairs(spark, sf_dir, "train", 2))


def log_softmax(spark, sf_dir):
    return ngram.log_softmax(_logits(spark, sf_dir)).select("context", "target", F.round("logp", 6).alias("logp"))


def cross_entropy(spark, sf_dir):
    held = _split_pairs(spark, sf_dir, "valid")
    report = ngram.cross_entropy(held, _model(spark, sf_dir), VOCAB_SIZE, ALPHA)
    return report.withColumn("mean_nll", F.round("mean_nll", 6))


def perplexity(spark, sf_dir):
    held = _split_pairs(spark, sf_dir, "valid")
    report = ngram.perplexity(held, _model(spark, sf_dir), VOCAB_SIZE, ("lang",), ALPHA)
    return report.withColumn("ppl", F.round("ppl", 6))


def perplexity_by_document(spark, sf_dir):
    held = _split_pairs(spark, sf_dir, "valid")
    report = ngram.perplexity(held, _model(spark, sf_dir), VOCAB_SIZE, ("doc_id",), ALPHA)
    return report.withColumn("ppl", F.round("ppl", 6))


def next_token_topk(spark, sf_dir):
    top = ngram.next_token_topk(_logits(spark, sf_dir), 5, 0.8)
    return top.select("context", "token", F.round("logit", 6).alias("logit"), F.round("prob", 6).alias("prob"))


def _prompts(spark, sf_dir) -> DataFrame:
    return codec.encode(_table(spark, sf_dir, "benchmark"), tokenizer(spark, sf_dir), keep=("item_id",))


def _sampling_table(spark, sf_dir) -> DataFrame:
    return ngram.next_token_topk(_logits(spark, sf_dir), 40, 0.8)


def sample_next(spark, sf_dir):
    states = _prompts(spark, sf_dir).select("item_id", F.try_element_at("ids", F.lit(-1)).cast("bigint").alias("context"))
    return ngram.sample_next(states, _sampling_table(spark, sf_dir), VOCAB_SIZE, SEED).select("item_id", "token")


def _generated(spark, sf_dir) -> DataFrame:
    return ngram.generate_batch(_prompts(spark, sf_dir), _sampling_table(spark, sf_dir), VOCAB_SIZE, 8, SEED, key="item_id")


def generate_batch(spark, sf_dir):
    return _generated(spark, sf_dir).select("item_id", _comma(F.col("ids")).alias("ids"), "n_new")


def generate_until_stop(spark, sf_dir):
    """Prompts that go on until a full stop, or for 24 tokens."""
    out = ngram.generate_batch(
        _prompts(spark, sf_dir), _sampling_table(spark, sf_dir), VOCAB_SIZE, 24, SEED, stop_token=STOP_TOKEN, key="item_id"
    )
    return out.select("item_id", _comma(F.col("ids")).alias("ids"), "n_new")


def generate_text(spark, sf_dir):
    return codec.decode(_generated(spark, sf_dir), tokenizer(spark, sf_dir), keep=("item_id", "n_new"))


# Vectors


def _components(df: DataFrame, key: str, vec_col: str) -> DataFrame:
    return vectors.exploded(df, key, vec_col).select(key, "i", F.round("x", 6).alias("x"))


def _by_digits(name: str, digits: int) -> Column:
    """``F.round`` of a double, which goes through decimals, but for those that are near a tie, large or no number by arithmetic."""
    scaled = F.col(name) * F.lit(10.0**digits)
    plain = (F.abs(scaled) < F.lit(2.0**40)) & (F.abs(scaled - F.floor(scaled) - F.lit(0.5)) > F.lit(1e-3))
    return F.when(plain, F.rint(scaled) / F.lit(10.0**digits) + F.lit(0.0)).otherwise(F.round(name, digits))


def rms_normalize(spark, sf_dir):
    return _components(vectors.rms_normalize(_table(spark, sf_dir, "embeddings")), "vec_id", "normed")


def projection_weights(spark: SparkSession, n: int, m: int) -> DataFrame:
    """A fixed (i, j, w) matrix for the projection query."""
    cells = spark.range(n * m).select(
        F.expr(f"cast(id div {m} as int)").alias("i"), (F.col("id") % m).cast("int").alias("j")
    )
    return cells.withColumn("w", ((F.col("i") * 7 + F.col("j") * 13) % 11 - 5) / F.lit(10.0))


def project_vectors(spark, sf_dir):
    table = _table(spark, sf_dir, "embeddings")
    width = table.agg(F.max(F.size("embedding"))).first()[0]
    projected = vectors.project_vectors(table, projection_weights(spark, width, 16))
    return _components(projected, "vec_id", "projected")


def project_vectors_wide(spark, sf_dir):
    """Every vector times a matrix that has all vectors as columns, multiplied by blocks that stay in Spark."""
    table = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    columns = vectors.exploded(table, "vec_id", "embedding").select("i", F.col("vec_id").cast("int").alias("j"), F.col("x").alias("w"))
    # A row for each pair of vectors: with equal products side by side they take less than half the space.
    projected = vectors.project_vectors(table, columns, broadcast_bytes=0, columns=PROJECTED_COLUMNS)
    rows = vectors.exploded_in_runs(projected, "vec_id", "projected", "first", 6)
    return rows.select("vec_id", "i", _by_digits("x", 6).alias("x"))


def embedding_lookup(spark, sf_dir):
    table = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    n = table.count()
    tokens = encoded(spark, sf_dir).select("doc_id", F.posexplode("ids").alias("pos", "token"))
    tokens = tokens.withColumn("vec_id", (F.col("token") % n).cast("bigint"))
    found = vectors.embedding_lookup(tokens, table)
    first = F.round(F.col("embedding")[0].cast("double"), 6)
    return found.select("doc_id", "pos", "vec_id", first.alias("x0"))


def similarity_topk(spark, sf_dir):
    table = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vectors.similarity_topk(table, table, 5)


def similarity_topk_exact(spark, sf_dir):
    """Ranked by scores that are not rounded; they are shown with nine decimals."""
    table = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    best = vectors.similarity_topk(table, table, 5, exact=True)
    return best.withColumn("score", F.round("score", 9))


def causal_weighted_mean(spark, sf_dir):
    mixed = vectors.causal_weighted_mean(_table(spark, sf_dir, "embeddings"), WINDOW)
    return _components(mixed, "vec_id", "mixed")


def causal_topk_mean(spark, sf_dir):
    mixed = vectors.causal_topk_mean(_table(spark, sf_dir, "embeddings"), WINDOW, 4)
    return _components(mixed, "vec_id", "mixed")


# Trainer


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = trainer.example_features(encoded(spark, sf_dir), _table(spark, sf_dir, "labels"))
    return Workspace(spark, "features").save(rows, "features")


def _start_params(rows: DataFrame) -> DataFrame:
    keys = rows.select("param_key").distinct()
    value = (F.pmod(F.col("param_key") * 37, F.lit(11)) - 5) / F.lit(10.0)
    return keys.select(
        F.lit(0).alias("run_id"), "param_key", value.alias("value"), F.lit(0.01).alias("m"), F.lit(0.02).alias("v")
    )


def _full_gradient(rows: DataFrame) -> DataFrame:
    examples = rows.select(F.lit(0).alias("run_id"), "doc_id", F.lit(1.0).alias("w"), "y", "param_key", "x")
    return trainer.gradient_sum(examples, _start_params(rows))


def gradient_sum(spark, sf_dir):
    return _full_gradient(features(spark, sf_dir)).select("param_key", F.round("grad", 9).alias("grad"))


def _rounded(params: DataFrame, columns: Sequence[str]) -> DataFrame:
    return params.select("param_key", *[F.round(c, 9).alias(c) for c in columns])


def adamw_step(spark, sf_dir):
    rows = features(spark, sf_dir)
    after = trainer.adamw_step(_start_params(rows), _full_gradient(rows), 3, SINGLE_RUN)
    return _rounded(after, ("value", "m", "v"))


def train_loglinear(spark, sf_dir):
    return _rounded(trainer.train_loglinear(features(spark, sf_dir), SINGLE_RUN, STEPS, SEED).params, ("value",))


def _log_columns(log: DataFrame) -> DataFrame:
    return log.select("run_id", "step", F.round("loss", 6).alias("loss"), F.round("ppl", 6).alias("ppl"))


def training_log(spark, sf_dir):
    return _log_columns(trainer.train_loglinear(features(spark, sf_dir), SINGLE_RUN, STEPS, SEED).log)


def _sweep_log(spark, sf_dir) -> DataFrame:
    return trainer.train_loglinear(features(spark, sf_dir), SWEEP, STEPS, SEED).log


def hyperparam_sweep(spark, sf_dir):
    return _log_columns(_sweep_log(spark, sf_dir))


def hyperparam_report(spark, sf_dir):
    """One loss column per run of the sweep."""
    return trainer.sweep_report(_log_columns(_sweep_log(spark, sf_dir)), SWEEP)


def target_gate(spark, sf_dir):
    gate = trainer.target_gate(_log_columns(_sweep_log(spark, sf_dir)), 0.69)
    return gate.select("run_id", "best_loss", "best_step", "final_loss", "passed")


# Streams


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streaming.stream_corpus(spark, sf_dir, DOCUMENTS_SCHEMA, "documents.parquet", spread_by="doc_id")


def stream_encode(spark, sf_dir):
    workspace = Workspace(spark, "stream")
    target = f"{workspace.path}/encoded"
    streaming.stream_encode(_stream(spark, sf_dir), tokenizer(spark, sf_dir), target, f"{workspace.path}/state")
    return spark.read.parquet(target).select("doc_id", _comma(F.col("ids")).alias("ids"), "n_tokens")


def stream_pretoken_freq(spark, sf_dir):
    workspace = Workspace(spark, "stream")
    target = f"{workspace.path}/freq"
    streaming.stream_pretoken_freq(_stream(spark, sf_dir), target, f"{workspace.path}/state", specials=SPECIALS)
    return streaming.latest_freq(spark, target)


def stream_corpus_stats(spark, sf_dir):
    workspace = Workspace(spark, "stream")
    target = f"{workspace.path}/stats"
    streaming.stream_corpus_stats(_stream(spark, sf_dir), tokenizer(spark, sf_dir), target, f"{workspace.path}/state")
    return streaming.running_stats(spark, target).withColumn("ratio", F.round("ratio", 6))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        scan_corpus, byte_budget, split_documents, train_valid_split, pack_token_ids, tokenizer_save_load,
        job_checkpoint, strip_specials, split_specials, pretokenize, pretokenize_pages, utf8_byte_ids,
        next_token_pairs, pretoken_freq, pair_counts, best_pair, apply_merge, pair_count_delta, train_bpe,
        build_vocab, encode, encode_by_dictionary, encode_conversations, decode, roundtrip_check, roundtrip_check_pages, sample_docs,
        compression_ratio, throughput_report, token_stream, token_store_documents, sample_windows, window_pairs, window_loss,
        fit_ngram, fit_ngram_order2,
        log_softmax, cross_entropy, perplexity, perplexity_by_document, next_token_topk, sample_next,
        generate_batch, generate_until_stop, generate_text, rms_normalize, project_vectors, project_vectors_wide, embedding_lookup, similarity_topk, similarity_topk_exact,
        causal_weighted_mean, causal_topk_mean, gradient_sum, adamw_step, train_loglinear, training_log,
        hyperparam_sweep, hyperparam_report, target_gate, stream_encode, stream_pretoken_freq, stream_corpus_stats,
    )
}
QUERIES["vocab_stats"] = vocab_statistics
