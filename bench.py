"""Headline timings as one JSON line.

Reads $BENCH_SF_DIR (default sf0.1) on local[$BENCH_CPUS]. Every query runs in
full: results go to the no-op sink or are small reports. Each time is one run
after a small warm-up of the JVM on the same tables.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tokenlake.operators import bpe, codec, pretoken, stats  # noqa: E402
from tokenlake.plans import queries as plans  # noqa: E402
from tokenlake.session import build_session  # noqa: E402

N_MERGES = 500


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 1))
    spark = build_session(
        f"local[{cpus}]",
        "bench",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    kept: dict[str, object] = {}

    def timed(name, run):
        started = time.perf_counter()
        kept[name] = run()
        times[name] = round(time.perf_counter() - started, 3)

    docs = plans.documents(spark, sf_dir, "doc_id", "text", "lang")
    drain(pretoken.pretoken_freq(docs))

    timed("pretoken_freq", lambda: drain(pretoken.pretoken_freq(docs)))
    timed("train_bpe", lambda: bpe.train_bpe(docs, 257 + N_MERGES, plans.SPECIALS))
    large = kept["train_bpe"]
    timed("encode_500_merges", lambda: drain(codec.encode(docs, large)))
    timed("compression_ratio_500_merges", lambda: stats.compression_ratio(docs, large, ("lang",)).collect())
    # The registered queries share a tokenizer of 60 merges.
    timed("train_bpe_60", lambda: plans.tokenizer(spark, sf_dir))
    timed("write_encoded", lambda: plans.encoded(spark, sf_dir))
    for name in (
        "encode", "decode", "roundtrip_check", "compression_ratio", "byte_budget", "token_stream", "sample_windows",
        "next_token_pairs", "fit_ngram", "log_softmax", "cross_entropy", "perplexity", "next_token_topk", "sample_next",
        "generate_batch", "rms_normalize", "project_vectors", "embedding_lookup", "similarity_topk",
        "causal_weighted_mean", "causal_topk_mean", "gradient_sum", "train_loglinear", "hyperparam_sweep",
        "stream_encode", "stream_pretoken_freq", "stream_corpus_stats",
    ):
        timed(name, lambda: drain(plans.QUERIES[name](spark, sf_dir)))

    n_bytes = docs.selectExpr("sum(octet_length(text))").first()[0]
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "corpus_bytes": n_bytes,
                "encode_bytes_per_sec": round(n_bytes / times["encode_500_merges"]),
                "merges": N_MERGES,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
