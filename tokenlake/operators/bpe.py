"""Learning a byte-pair vocabulary as a distributed iterative job.

The corpus is reduced once to distinct words with counts. Each round then runs
one job over the words:

* The driver holds the exact counts of the most frequent pairs (``_Leaders``), a
  bounded number. Every other pair is known to rank below a floor, and a merge
  never raises the count of an existing pair, so the best pair is certain as
  long as a leader ranks above the floor. Otherwise pairs are recounted.
* The driver guesses the next few merges, by trying them on the most frequent
  words, a sample of bounded size (``_Guesser``). The job applies the guesses one
  after the other to the words that contain any of them and sums, per merge, the
  changes of the pair counts.
* The driver replays the changes in order. A guess stands if it is the best pair
  at its turn; the first wrong guess and all later ones are dropped. The merges
  are therefore the ones that a one-at-a-time loop finds, in fewer jobs.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenlake.functions import chars
from tokenlake.operators.pretoken import pretoken_freq, word_table
from tokenlake.operators.tokenizer import N_BYTES, Merge, Tokenizer
from tokenlake.sources.corpus import byte_budget
from tokenlake.shipping import ship_package
from tokenlake.sources.job_checkpoint import JobCheckpoint, fingerprint
from tokenlake.workspace import Workspace

WORDS_PER_TASK = 10_000
LOOP_PARTITIONS = 8
# Distinct changes that a task holds before it hands them on.
CHANGES_AT_ONCE = 1_000_000

# (left id, right id, new id)
Rule = tuple[int, int, int]


def pair_counts(words: DataFrame) -> DataFrame:
    """(word, freq) -> (a, b, cnt) over all adjacent positions."""
    # Plain explodes stay in generated code; higher-order functions would not.
    counted = (
        words.filter("length(word) > 1")
        .selectExpr("freq", "split(word, '') as p")
        .selectExpr("freq", "p", "explode(sequence(1, size(p) - 1)) as i")
        .selectExpr("freq", "concat(p[i - 1], p[i]) as pair")
        .groupBy("pair")
        .agg(F.sum("freq").alias("cnt"))
    )
    a, b = chars.pair_ids(F.col("pair"))
    return counted.select(a.alias("a"), b.alias("b"), "cnt")


def best_pair(counts: DataFrame) -> DataFrame:
    """The pair with the highest count; ties go to the largest (a, b)."""
    top = counts.agg(F.max(F.struct("cnt", "a", "b")).alias("top"))
    return top.filter("top is not null").select("top.a", "top.b", "top.cnt")


def _pair_text(rule: Rule) -> str:
    return chars.symbol(rule[0]) + chars.symbol(rule[1])


def _sql(symbols: str) -> str:
    """A string literal that needs no escaping."""
    return f"decode(X'{symbols.encode('utf-8').hex()}', 'UTF-8')"


def _replaced(word: str, rules: Sequence[Rule]) -> str:
    """SQL for ``word`` with the rules applied in turn.

    The chain is padded to a multiple of four steps with replacements of a mark
    that no word holds, so that rounds share their generated code.
    """
    steps = [(_pair_text(r), chars.symbol(r[2])) for r in rules]
    steps += [(chars.BOUNDARY, chars.BOUNDARY)] * (-len(steps) % 4)
    for old, new in steps:
        word = f"replace({word}, {_sql(old)}, {_sql(new)})"
    return word


def apply_merge(words: DataFrame, a: int, b: int, new_id: int) -> DataFrame:
    """Adds ``merged``: the word with each left-to-right pair replaced."""
    return words.withColumn("merged", F.expr(_replaced("word", [(a, b, new_id)])))


def merge_words(words: DataFrame, a: int, b: int, new_id: int) -> DataFrame:
    """(word, freq) after one merge. Different words stay different, so there is
    nothing to aggregate again."""
    return words.selectExpr(_replaced("word", [(a, b, new_id)]) + " as word", "freq")


_DELTAS = pa.schema([("stage", pa.int32()), ("a", pa.int32()), ("b", pa.int32()), ("change", pa.int64())])


def staged_deltas(words: DataFrame, rules: Sequence[Rule], wanted: frozenset[int] | None = None) -> DataFrame:
    """(stage, a, b, delta): what each rule, applied after those before it,
    changes in the pair counts.

    Only words that hold one of the pairs leave the JVM. A pair with an id that an earlier rule makes can only arise in a
    word that holds that rule's pair. The rules go along as data, so every round has the same plan; tasks add up their
    changes before the shuffle. With ``wanted``, changes of pairs without a new id are given for these codes only.
    """
    ship_package(words.sparkSession)
    steps = [(_pair_text(r), chars.symbol(r[2])) for r in rules]
    first_new = min(r[2] for r in rules)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: list[dict[str, int]] = [{} for _ in steps]

        def flush() -> Iterator[pa.RecordBatch]:
            rows = []
            for stage, changes in enumerate(sums):
                for pair, change in changes.items():
                    a, b = chars.id_of(pair[0]), chars.id_of(pair[1])
                    if change and (wanted is None or a >= first_new or b >= first_new or chars.pair_code(a, b) in wanted):
                        rows.append((stage, a, b, change))
                changes.clear()
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _DELTAS)] if rows else [pa.array([], f.type) for f in _DELTAS], schema=_DELTAS)

        for batch in batches:
            for word, freq in zip(batch.column("word").to_pylist(), batch.column("freq").to_pylist()):
                for changes, (old, new) in zip(sums, steps):
                    if old in word:
                        after = word.replace(old, new)
                        for i in range(len(word) - 1):
                            pair = word[i : i + 2]
                            changes[pair] = changes.get(pair, 0) - freq
                        for i in range(len(after) - 1):
                            pair = after[i : i + 2]
                            changes[pair] = changes.get(pair, 0) + freq
                        word = after
            if sum(map(len, sums)) > CHANGES_AT_ONCE:
                yield from flush()
        yield from flush()

    # SQL text instead of Column objects: the loop builds this once per round.
    touched = " or ".join(f"contains(word, {_sql(old)})" for old, _ in steps)
    changes = words.filter(touched).select("word", "freq").mapInArrow(count, "stage int, a int, b int, change long")
    return changes.groupBy("stage", "a", "b").agg(F.sum("change").alias("delta")).filter("delta <> 0")


def pair_count_delta(words: DataFrame, counts: DataFrame, a: int, b: int, new_id: int) -> DataFrame:
    """``counts`` of ``words`` brought up to date for one merge; equals a recount."""
    delta = staged_deltas(words, [(a, b, new_id)]).select("a", "b", F.col("delta").alias("cnt"))
    return counts.unionByName(delta).groupBy("a", "b").agg(F.sum("cnt").alias("cnt")).filter("cnt > 0")


class _Leaders:
    """Exact counts of all pairs that rank above a floor.

    Ranks are (count, pair code); the floor only ever rises until a recount.
    """

    def __init__(self, limit: int):
        self.limit = limit
        self.counts: dict[int, int] = {}
        self.floor = (0, 0)

    def refill(self, words: DataFrame) -> None:
        ranked = (
            pair_counts(words)
            .selectExpr("cnt", f"a * {chars.PAIR_BASE}L + b as code")
            .orderBy(F.desc("cnt"), F.desc("code"))
        )
        rows = ranked.limit(self.limit).collect()
        self.counts = {r["code"]: r["cnt"] for r in rows}
        self.floor = (rows[-1]["cnt"], rows[-1]["code"]) if len(rows) == self.limit else (0, 0)

    @property
    def complete(self) -> bool:
        """No pair exists outside the leaders."""
        return self.floor == (0, 0)

    def best(self) -> tuple[int, int] | None:
        """(count, code) of the best pair if a leader is certain to be it."""
        top = max(((n, c) for c, n in self.counts.items()), default=None)
        return top if top is not None and top >= self.floor else None

    def apply(self, merged: int, changes: Iterable[tuple[int, int]], new_id: int) -> None:
        for code, delta in changes:
            if code in self.counts:
                self.counts[code] += delta
                if self.counts[code] <= 0:
                    del self.counts[code]
            elif new_id in chars.split_pair_code(code) and (delta, code) >= self.floor:
                self.counts[code] = delta
        self.counts.pop(merged, None)

    def trim(self) -> None:
        if len(self.counts) > 2 * self.limit:
            kept = heapq.nlargest(self.limit, ((n, c) for c, n in self.counts.items()))
            self.counts = {c: n for n, c in kept}
            self.floor = max(self.floor, kept[-1])


class _Guesser:
    """Guesses the next merges from a sample of the words.

    A guess costs nothing but time when it is wrong: the job's exact counts
    decide. The sample is the most frequent words, which carry most of the counts.
    """

    def __init__(self, words: DataFrame, limit: int):
        # Words per power of two of the count; no sort is needed to find the frequent ones.
        sizes = words.groupBy(F.floor(F.log2("freq")).alias("power")).count().collect()
        least, taken = 64, 0
        for power, n in sorted(map(tuple, sizes), reverse=True):
            if taken and taken + n > limit:
                break
            least, taken = power, taken + n
        rows = words.filter(F.col("freq") >= F.lit(2**least)).limit(limit).collect()
        self.sample = [(r["word"], r["freq"]) for r in rows]

    def advance(self, rules: Sequence[Rule]) -> None:
        """Apply merges that were accepted."""
        for rule in rules:
            old, new = _pair_text(rule), chars.symbol(rule[2])
            self.sample = [(w.replace(old, new), n) if old in w else (w, n) for w, n in self.sample]

    def guess(self, leaders: _Leaders, k: int, next_id: int) -> list[Rule]:
        top = heapq.nlargest(1024, ((n, c) for c, n in leaders.counts.items()))
        # Estimated (count, left id, right id); compares like the exact ranks.
        estimates = {}
        for n, code in top:
            a, b = chars.split_pair_code(code)
            estimates[chars.symbol(a) + chars.symbol(b)] = (float(n), a, b)
        trial = list(self.sample)
        rules: list[Rule] = []
        while len(rules) < k and estimates:
            pair = max(estimates, key=estimates.__getitem__)
            count, a, b = estimates.pop(pair)
            if rules and count < max(1, leaders.floor[0]):
                break
            rule = (a, b, next_id + len(rules))
            rules.append(rule)
            new = chars.symbol(rule[2])
            change: dict[str, int] = {}
            seen = 0
            for i, (word, freq) in enumerate(trial):
                if pair in word:
                    merged = word.replace(pair, new)
                    trial[i] = (merged, freq)
                    seen += freq * (len(word) - len(merged))
                    for p in zip(word, word[1:]):
                        change[p] = change.get(p, 0) - freq
                    for p in zip(merged, merged[1:]):
                        change[p] = change.get(p, 0) + freq
            # The sample sees part of the pair's occurrences; scale up to all of them.
            scale = count / seen if seen else 0.0
            for (x, y), delta in change.items():
                if x + y in estimates:
                    n, left, right = estimates[x + y]
                    estimates[x + y] = (n + scale * delta, left, right)
                elif delta > 0 and new in (x, y):
                    estimates[x + y] = (scale * delta, chars.id_of(x), chars.id_of(y))
        return rules


def _leader_changes(words: DataFrame, rules: Sequence[Rule], leaders: _Leaders) -> list[list[tuple[int, int]]]:
    """Per stage, the changes that concern leaders or pairs that may become one."""
    first_new = rules[0][2]
    merged_ids = {i for rule in rules for i in rule[:2]}
    near = frozenset(c for c in leaders.counts if not merged_ids.isdisjoint(chars.split_pair_code(c)))
    rows = (
        staged_deltas(words, rules, near)
        .filter(f"(a < {first_new} and b < {first_new}) or delta < 0 or delta >= {leaders.floor[0]}")
        .selectExpr("stage", f"a * {chars.PAIR_BASE}L + b as code", "delta")
        .collect()
    )
    by_stage: list[list[tuple[int, int]]] = [[] for _ in rules]
    for stage, code, delta in rows:
        by_stage[stage].append((code, delta))
    return by_stage


def train_bpe_words(
    words: DataFrame,
    n_merges: int,
    first_id: int = N_BYTES,
    *,
    max_guesses: int = 32,
    leaders_limit: int = 4096,
    sample_words: int = 8192,
    rounds_per_table: int = 12,
    checkpoint: JobCheckpoint | None = None,
    save_every: int = 100,
) -> list[Merge]:
    """Merges learned from (word, freq). Stops early when no pair is left.

    With a ``checkpoint`` the state is written every ``save_every`` merges and a
    later call with the same checkpoint goes on from the newest complete one; it fails for other words or another first id.
    """
    merges: list[Merge] = []
    if n_merges <= 0:
        return merges
    workspace = Workspace(words.sparkSession, "bpe")
    resumed = checkpoint.claim(fingerprint(words, job="bpe", first_id=first_id)) if checkpoint is not None else None
    if resumed is not None:
        merges = [Merge(a, b, cnt) for a, b, cnt in resumed.meta["merges"]]
        table = f"{resumed.path}/words"
    else:
        workspace.save(words.filter(F.length("word") > 1), "words")
        table = f"{workspace.path}/words"
    loop = words.sparkSession.newSession()
    workspace.spark = loop
    current = _spread(loop.read.parquet(table)).persist()
    leaders = _Leaders(leaders_limit)
    leaders.refill(current)
    guesser = _Guesser(current, sample_words)
    replaced: DataFrame | None = None
    rounds, saved_at, k = 0, len(merges), 8
    while len(merges) < n_merges:
        if leaders.best() is None and not leaders.complete:
            leaders.refill(current)
        if leaders.best() is None:
            break
        rules = guesser.guess(leaders, k, first_id + len(merges))
        changes = _leader_changes(current, rules, leaders)
        accepted: list[Rule] = []
        for rule, changed in zip(rules, changes):
            top = leaders.best()
            code = chars.pair_code(rule[0], rule[1])
            if top is None or top[1] != code or len(merges) == n_merges:
                break
            merges.append(Merge(rule[0], rule[1], top[0]))
            accepted.append(rule)
            leaders.apply(code, changed, rule[2])
        leaders.trim()
        guesser.advance(accepted)
        # Guess further than this round got; few sizes, to share generated code.
        k = 8
        while k < min(2 * len(accepted), max_guesses):
            k = min(2 * k, max_guesses)
        rounds += 1

        # The new words are computed by the job of the next round, from the
        # words of this one, which are therefore kept for one more round.
        renamed = current.selectExpr(_replaced("word", accepted) + " as word", "freq")
        if rounds % rounds_per_table == 0:
            renamed = workspace.save(renamed, f"words-{rounds}")
        if replaced is not None:
            replaced.unpersist()
        replaced, current = current, renamed.persist()
        if checkpoint is not None and len(merges) - saved_at >= save_every:
            checkpoint.save(len(merges), {"words": current}, {"merges": [(m.a, m.b, m.cnt) for m in merges]})
            saved_at = len(merges)
    if replaced is not None:
        replaced.unpersist()
    current.unpersist()
    return merges[:n_merges]


def _spread(words: DataFrame) -> DataFrame:
    """Even partitions, with at most one task per core and no tiny tasks.

    Also sets up the session of the loop, which runs many small jobs: a round
    shuffles only the pairs next to its merges, so a few fixed partitions do and
    there is nothing to re-plan at run time. Other sessions are not affected.
    """
    loop = words.sparkSession
    cores = loop.sparkContext.defaultParallelism
    tasks = max(1, min(cores, words.count() // WORDS_PER_TASK))
    loop.conf.set("spark.sql.adaptive.enabled", "false")
    loop.conf.set("spark.sql.shuffle.partitions", str(max(min(cores, LOOP_PARTITIONS), tasks // 8)))
    return words.repartition(tasks, "word")


def train_bpe(
    documents: DataFrame,
    vocab_size: int,
    specials: Sequence[str] = (),
    *,
    max_bytes: int | None = None,
    text_col: str = "text",
    order_col: str = "doc_id",
    **loop,
) -> Tokenizer:
    """Learn ``vocab_size`` - 256 - specials merges from a table of documents."""
    if max_bytes is not None:
        documents = byte_budget(documents, max_bytes, order_col, text_col)
    first_id = N_BYTES + len(specials)
    words = word_table(pretoken_freq(documents, text_col, specials))
    merges = train_bpe_words(words, vocab_size - first_id, first_id, **loop)
    return Tokenizer(tuple(merges), tuple(specials))
