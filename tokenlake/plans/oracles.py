"""DuckDB SQL that gives the same rows as the registered queries.

The statements are put together from common table expressions; they share no
code with the Spark operators.
"""

from __future__ import annotations

EOT = "<|endoftext|>"
SEP = EOT + "<|sep|>"
MERGES = 60
FIRST = 257
VOCAB = FIRST + MERGES
WINDOW = 32
SEED = 7
STEPS = 3
BIAS = -1

# Unicode white space as a character-class body, and the
# pre-tokenization pattern without look-ahead. The engine has none, so a mark
# is put before the last white-space character in front of a word.
WS = r"\s\x0b\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
PATTERN = (
    r"''(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^" + WS + r"\p{L}\p{N}\x{10fffd}]+|[" + WS + r"]+"
)


def pretokens(text: str) -> str:
    return (
        f"regexp_extract_all(regexp_replace({text}, '([{WS}][^{WS}])', chr(1114109) || '\\1', 'g'), '{PATTERN}')"
    )


def latin(text: str) -> str:
    """UTF-8 bytes of a string as characters U+0000..U+00FF."""
    byte = f"chr(('0x' || substr(hex(encode({text})), (2*i+1)::int, 2))::int)"
    return f"coalesce(list_aggregate(list_transform(range(0, strlen({text})), lambda i: {byte}), 'string_agg', ''), '')"


def md5_number(text: str, digits: int = 8) -> str:
    return f"('0x' || substr(md5({text}), 1, {digits}))::bigint"


def ids(coded: str) -> str:
    """Comma-joined code points of a string."""
    points = f"list_transform(string_split({coded}, ''), lambda c: ascii(c)::varchar)"
    return f"case when {coded} = '' then '' else list_aggregate({points}, 'string_agg', ',') end"


def points(coded: str) -> str:
    """As :func:`ids`, for tables of many short strings: no aggregate per row."""
    return f"case when {coded} = '' then '' else array_to_string(list_transform(string_split({coded}, ''), lambda c: ascii(c)), ',') end"


def marked(text: str) -> str:
    return f"replace(replace({text}, chr(10), '{SEP}'), '. ', '.{EOT}')"


# Common table expressions; each may use those before it.

WORDS = f"""
freqs as materialized (
  select p as pretoken, count(*) as freq
  from (select unnest({pretokens(f"replace(text, '{EOT}', '')")}) as p from documents) group by 1),
words as materialized (select pretoken, {latin('pretoken')} as w, freq as f from freqs)"""

PAIRS = """
pc as materialized (
  select ascii(p)::int as a, ascii(substr(p, 2, 1))::int as b, sum(f)::bigint as cnt
  from (select substr(w, i::int, 2) as p, f from (select w, f, unnest(range(1, length(w))) as i from words)) group by all),
top as materialized (select a, b, cnt from pc order by cnt desc, a desc, b desc limit 1)"""

BPE = f"""
bpe(it, w, f, a, c) as (
  select 0, w, f, null::varchar, null::bigint from words
  union all
  (with pcs as (select substr(w, i::int, 2) as p, sum(f) as c
                from (select w, f, unnest(range(1, length(w))) as i from bpe) group by 1),
        best as (select max(struct_pack(c := c, p1 := ascii(p), p2 := ascii(substr(p, 2, 1)), p := p)) as b from pcs)
   select it + 1, replace(w, best.b.p, chr(({FIRST} + it)::int)), f, best.b.p, best.b.c::bigint
   from bpe, best where it < {MERGES} and best.b is not null and best.b.c >= 1)),
merges as materialized (
  select distinct (it - 1)::int as rank, ascii(a)::int as a, ascii(substr(a, 2, 1))::int as b,
         ({FIRST} + it - 1)::int as new_id, c as cnt, a as pair, chr(({FIRST} + it - 1)::int) as x
  from bpe where it > 0)"""

VOCAB_CTE = f"""
toks(it, t) as (
  select 0, list_append(list_transform(range(0, 256), lambda i: printf('%02X', i)), hex(encode('{EOT}')))
  union all
  select it + 1, list_append(t, t[a + 1] || t[b + 1]) from toks join merges on rank = it),
vocab as materialized (
  select i::int as token_id, t[i + 1] as token, (length(t[i + 1]) // 2)::int as n_bytes,
         case when i < 256 then 'byte' when i < {FIRST} then 'special' else 'merge' end as kind
  from (select t, unnest(range(0, len(t))) as i from toks where it = (select max(it) from toks)))"""

RULES = """
ms as materialized (select list(struct_pack(p := pair, x := x) order by rank) as ms from merges)"""


def dictionary(source: str) -> str:
    """dict(pretoken, t): tokens of each pre-token of ``source``(pretoken, w)."""
    return f"""
dict as materialized (
  select pretoken, list_reduce(list_prepend(struct_pack(p := '', x := w), ms),
    lambda acc, q: struct_pack(p := '', x := replace(acc.x, q.p, q.x))).x as t
  from {source}, ms)"""


ENC = f"""
{RULES.strip()},{dictionary('words')},
placed as (select doc_id, unnest(toks) as pretoken, unnest(range(0, len(toks))) as pos
           from (select doc_id, {pretokens('text')} as toks from documents)),
coded as (select doc_id, string_agg(t, '' order by pos) as s from placed join dict using (pretoken) group by doc_id),
enc as materialized (select d.doc_id, d.lang, coalesce(s, '') as s, length(coalesce(s, ''))::int as n_tokens
                     from documents d left join coded using (doc_id))"""

TOKENS = """
tok as materialized (
  select doc_id, lang, (unnest(range(0, length(s))))::int as pos, ascii(unnest(string_split(s, '')))::int as token
  from enc where s <> '')"""

STREAM = """
stream as materialized (select row_number() over (order by doc_id, pos) - 1 as pos, doc_id, token from tok)"""

WINDOWS = f"""
starts as materialized (
  select i as sample_id, {md5_number(f"'{SEED}:' || i", 15)} % ((select count(*) from stream) - {WINDOW} - 1) as start
  from (select unnest(range(0, 64)) as i)),
windows as materialized (
  select sample_id, start, pos, token
  from (select sample_id, start, start + unnest(range(0, {WINDOW})) as pos from starts) join stream using (pos))"""

BUCKETS = f"""
buckets as materialized (select doc_id, ({md5_number('doc_id::varchar')} % 100)::int as bucket from documents)"""

NGRAM = f"""
{BUCKETS.strip()},
prs as materialized (
  select * from (select doc_id, lang, pos, token as context, lead(token) over (partition by doc_id order by pos) as target
                 from tok) where target is not null),
ng as materialized (select context::bigint as context, target, count(*) as cnt
                    from prs join buckets using (doc_id) where bucket >= 10 group by all),
totals as (select context, sum(cnt) as total from ng group by 1),
held as materialized (
  select doc_id, lang, -ln((coalesce(cnt, 0) + 1.0) / (coalesce(total, 0) + 1.0 * {VOCAB})) as nll
  from (select prs.* from prs join buckets using (doc_id) where bucket < 10) p
  left join ng on ng.context = p.context and ng.target = p.target
  left join totals on totals.context = p.context)"""


def topk(k: int) -> str:
    return f"""
kept as (select context, target as token, ln(cnt) / 0.8 as logit from ng
         qualify rank() over (partition by context order by ln(cnt) / 0.8 desc) <= {k}),
topk as materialized (
  select context, token, logit, exp(logit - m) / sum(exp(logit - m)) over (partition by context) as prob
  from (select *, max(logit) over (partition by context) as m from kept))"""


PROMPTS = f"""
pwords as materialized (select distinct p as pretoken, {latin('p')} as w
                        from (select unnest({pretokens('text')}) as p from benchmark)),
pdict as materialized (
  select pretoken, list_reduce(list_prepend(struct_pack(p := '', x := w), ms),
    lambda acc, q: struct_pack(p := '', x := replace(acc.x, q.p, q.x))).x as t
  from pwords, ms),
prompts as materialized (
  select item_id, string_agg(t, '' order by pos) as s
  from (select item_id, unnest(toks) as pretoken, unnest(range(0, len(toks))) as pos
        from (select item_id, {pretokens('text')} as toks from benchmark)) join pdict using (pretoken)
  group by item_id)"""


def uniform(*parts: str) -> str:
    key = " || ':' || ".join(f"({p})::varchar" for p in parts)
    return f"(({md5_number(key)} + 0.5) / 4294967296.0)"


def gumbel(*parts: str) -> str:
    return f"(-ln(-ln({uniform(*parts)})))"


GENERATED = f"""
gen(step, item_id, s) as (
  select 0, item_id, s from prompts
  union all
  (select step + 1, item_id, s || chr(coalesce(
            arg_max(token, struct_pack(score := logit + {gumbel(str(SEED), 'item_id', 'step', 'token')}, token := token)),
            floor({uniform(str(SEED), 'item_id', 'step')} * {VOCAB}))::int)
   from gen left join topk on context = ascii(right(s, 1)) where step < 8 group by step, item_id, s))"""

FEATURES = f"""
labelled as materialized (select e.doc_id, l.quality::double as y, e.n_tokens from enc e join labels l using (doc_id)),
feat as materialized (
  select doc_id, y, token::bigint as k, count(*) / greatest(n_tokens, 1)::double as x
  from labelled join tok using (doc_id) group by doc_id, y, token, n_tokens
  union all select doc_id, y, {BIAS}, 1.0 from labelled),
keys as (select distinct k from feat)"""


def gradient(batch: str, params: str, name: str) -> str:
    """{name}s: examples with p; {name}g(run, k, grad)."""
    return f"""
{name}s as materialized (
  select run, doc_id, any_value(w) as w, any_value(y) as y, 1.0 / (1.0 + exp(-sum(value * x))) as p
  from {batch} join {params} using (run, k) group by run, doc_id),
{name}g as materialized (
  select run, k, sum(s.w * (s.p - s.y) * x) / any_value(n) as grad
  from {batch} join {name}s s using (run, doc_id)
  join (select run, sum(w) as n from {name}s group by run) using (run) group by run, k)"""


def adamw(params: str, grads: str, step: str, name: str) -> str:
    return f"""
{name} as materialized (
  select run, k, value - lr * ((m / (1 - power(0.9, {step}))) / (sqrt(v / (1 - power(0.999, {step}))) + 1e-8) + 0.01 * value)
         as value, m, v
  from (select run, k, lr, value, 0.9 * m + (1 - 0.9) * coalesce(grad, 0) as m,
               0.999 * v + (1 - 0.999) * (coalesce(grad, 0) * coalesce(grad, 0)) as v
        from {params} left join {grads} using (run, k) join runs using (run)))"""


def training(runs: list[tuple[int, float, int]]) -> str:
    rows = ", ".join(f"({i}, {lr}::double, {size})" for i, lr, size in runs)
    widest = max(size for _, _, size in runs)
    parts = [
        f"runs(run, lr, size) as (values {rows})",
        "numbered as materialized (select doc_id, row_number() over (order by doc_id) - 1 as number from labelled)",
        f"""drawn as materialized (
  select step, run, {md5_number(f"'{SEED}:' || step || ':' || slot", 15)} % (select count(*) from numbered) as number
  from (select unnest(range(1, {STEPS + 1})) as step), (select unnest(range(0, {widest})) as slot), runs where slot < size)""",
        """batch as materialized (
  select step, run, doc_id, w, y, k, x
  from (select step, run, number, count(*) as w from drawn group by all) join numbered using (number) join feat using (doc_id))""",
        "p0 as (select run, k, 0.0::double as value, 0.0::double as m, 0.0::double as v from keys, runs)",
    ]
    for s in range(1, STEPS + 1):
        parts.append(f"b{s} as (select * from batch where step = {s})")
        parts.append(gradient(f"b{s}", f"p{s - 1}", f"t{s}").strip())
        parts.append(adamw(f"p{s - 1}", f"t{s}g", str(s), f"p{s}").strip())
        parts.append(gradient(f"b{s}", f"p{s}", f"u{s}").strip())
        parts.append(
            f"l{s} as (select run as run_id, {s} as step,"
            f" sum(w * -ln(case when y > 0.5 then p else 1 - p end)) / sum(w) as loss from u{s}s group by run)"
        )
    logs = " union all ".join(f"select * from l{s}" for s in range(1, STEPS + 1))
    parts.append(
        f"log as materialized (select run_id::int as run_id, step::int as step, round(loss, 6) as loss,"
        f" round(exp(loss), 6) as ppl from ({logs}))"
    )
    return ",\n".join(parts)


SINGLE = training([(0, 0.05, 16)])
SWEEP = training([(0, 1e-4, 8), (1, 5e-4, 8), (2, 2e-3, 8), (3, 5e-4, 4), (4, 5e-4, 16), (5, 5e-4, 64)])

START = """
runs(run, lr) as (values (0, 0.05::double)),
start as (select 0 as run, k, ((((k * 37) % 11) + 11) % 11 - 5) / 10.0::double as value, 0.01::double as m, 0.02::double as v
          from keys),
full_batch as (select 0 as run, doc_id, 1.0::double as w, y, k, x from feat)"""

ATTENTION = f"""
rows as materialized (
  select vec_id, embedding::double[] as e, label,
         (row_number() over (partition by label order by vec_id) - 1) as pos from embeddings),
scored as materialized (
  select q.vec_id, k.vec_id as other, k.e as e, k.pos as kpos,
         list_dot_product(q.e, k.e) / sqrt(len(q.e)) as score
  from rows q join rows k on q.label = k.label and q.pos // {WINDOW} = k.pos // {WINDOW} and k.pos <= q.pos)"""


def attention(source: str) -> str:
    return f"""
shifted as (select *, exp(score - max(score) over (partition by vec_id)) as z from {source}),
weighted as (select vec_id, e, z / sum(z) over (partition by vec_id) as wt from shifted)"""


MIXED_ROWS = """select vec_id, i::int as i, round(sum(wt * x), 6) as x
from (select vec_id, wt, unnest(range(0, len(e))) as i, unnest(e) as x from weighted) group by vec_id, i"""


def build(*parts: str) -> str:
    *ctes, final = [p.strip() for p in parts]
    return "with recursive " + ",\n".join(ctes) + "\n" + final if ctes else final


TRAINED = (WORDS, BPE)
ENCODED = (WORDS, BPE, ENC)
TOKENIZED = (WORDS, BPE, ENC, TOKENS)
MODELLED = (WORDS, BPE, ENC, TOKENS, NGRAM)
LABELLED = (WORDS, BPE, ENC, TOKENS, FEATURES)
MERGE_ROWS = "select rank, a, b, new_id, cnt from merges"
ENCODED_ROWS = f"select doc_id, {ids('s')} as ids, n_tokens from enc"
FREQ_ROWS = "select pretoken, freq from freqs"

_PARTS = "regexp_extract_all(text, '" + "|".join(
    "".join("\\" + c if c in "<|>" else c for c in s) for s in (SEP, EOT)
) + "')"
_SPLIT = "string_split_regex(text, '" + "|".join(
    "".join("\\" + c if c in "<|>" else c for c in s) for s in (SEP, EOT)
) + "')"

SPLIT_PARTS = f"""
turns as (select conv_id, turn, {marked('text')} as text from conversations),
cut as (select conv_id, turn, {_SPLIT} as between, {_PARTS} as found from turns),
raw as (
  select conv_id, turn, 2 * unnest(range(0, len(between))) as place, false as is_special, unnest(between) as text from cut
  union all
  select conv_id, turn, 2 * unnest(range(0, len(found))) + 1, true, unnest(found) from cut),
parts as materialized (
  select conv_id, turn, (row_number() over (partition by conv_id, turn order by place) - 1)::int as part, is_special, text
  from raw where is_special or text <> '')"""

# Turns are encoded with the one special of the tokenizer; the rest of the long
# marker is plain text.
ENC_TURNS = f"""
tcut as (select conv_id, turn, string_split({marked('text')}, '{EOT}') as pieces from conversations),
tpieces as materialized (
  select conv_id, turn, unnest(pieces) as piece, unnest(range(0, len(pieces))) as part, len(pieces) as n from tcut),
tplaced as materialized (
  select conv_id, turn, part, unnest(toks) as pretoken, unnest(range(0, len(toks))) as pos
  from (select conv_id, turn, part, {pretokens('piece')} as toks from tpieces)),
tw as materialized (select pretoken, {latin('pretoken')} as w from (select distinct pretoken from tplaced)),
{RULES.strip()},{dictionary('tw')},
tcoded as (select conv_id, turn, part, string_agg(t, '' order by pos) as s from tplaced join dict using (pretoken) group by all),
tenc as materialized (
  select conv_id, turn, string_agg(coalesce(s, '') || case when part < n - 1 then chr(256) else '' end, '' order by part) as s
  from tpieces left join tcoded using (conv_id, turn, part) group by conv_id, turn)"""

CUT_BYTES = """
total as (select sum(strlen(text)) // 2 as lim from documents),
sized as (select doc_id, text, strlen(text) as n, sum(strlen(text)) over (order by doc_id) - strlen(text) as before
          from documents),
kept as materialized (
  select doc_id, before, n, text, lim, before + n > lim as crossing from sized, total where before < lim),
chars as (select doc_id, lim - before as room, unnest(string_split(text, '')) as c, unnest(range(0, length(text))) as i
          from kept where crossing),
prefix as (select doc_id, i, c, room, sum(strlen(c)) over (partition by doc_id order by i) as used from chars),
tail as (select doc_id, string_agg(c, '' order by i) as text from prefix where used <= room group by doc_id)"""


ORACLES: dict[str, str] = {
    "scan_corpus": "select doc_id, lang, source, strlen(text)::bigint as n_bytes from documents",
    "byte_budget": build(
        CUT_BYTES,
        """select k.doc_id, strlen(case when crossing then coalesce(t.text, '') else k.text end)::bigint as kept_bytes,
  case when crossing then coalesce(t.text, '') else k.text end as text from kept k left join tail t using (doc_id)""",
    ),
    "split_documents": (
        f"select doc_id, unnest(range(0, len(p)))::int as doc_pos, unnest(p) as text"
        f" from (select doc_id, string_split(replace(text, chr(10), '{EOT}'), '{EOT}') as p from documents)"
    ),
    "train_valid_split": build(
        BUCKETS, "select doc_id, bucket, case when bucket < 10 then 'valid' else 'train' end as split from buckets"
    ),
    "pack_token_ids": build(
        *TOKENIZED,
        """select doc_id, n_tokens, coalesce(max(token), 0)::int as max_id, 16 as width_bits
  from enc left join tok using (doc_id) group by doc_id, n_tokens""",
    ),
    "tokenizer_save_load": build(*TRAINED, "select rank, a, b, new_id from merges"),
    "job_checkpoint": build(*TRAINED, MERGE_ROWS),
    "strip_specials": (
        f"select conv_id, turn, replace(replace({marked('text')}, '{SEP}', ''), '{EOT}', '') as text from conversations"
    ),
    "split_specials": build(SPLIT_PARTS, "select conv_id, turn, part, is_special, text from parts"),
    "pretokenize": (
        "select doc_id, unnest(range(0, len(p)))::int as pos, unnest(p) as pretoken"
        f" from (select doc_id, {pretokens('text')} as p from documents)"
    ),
    "pretokenize_pages": (
        "select page_id, unnest(range(0, len(p)))::int as pos, unnest(p) as pretoken"
        f" from (select page_id, {pretokens('html')} as p from pages)"
    ),
    "utf8_byte_ids": f"select item_id, {ids('w')} as ids from (select item_id, {latin('text')} as w from benchmark)",
    "next_token_pairs": build(
        *TOKENIZED,
        """select * from (select doc_id, pos, token as context, lead(token) over (partition by doc_id order by pos) as target
  from tok) where target is not null""",
    ),
    "pretoken_freq": build(WORDS, FREQ_ROWS),
    "pair_counts": build(WORDS, PAIRS, "select a, b, cnt from pc"),
    "best_pair": build(WORDS, PAIRS, "select a, b, cnt from top"),
    "apply_merge": build(
        WORDS,
        PAIRS,
        f"""select {points('w')} as before, {points('m')} as after, freq
  from (select w, replace(w, chr(a) || chr(b), chr({FIRST})) as m, f as freq from words, top)""",
    ),
    "pair_count_delta": build(
        WORDS,
        PAIRS,
        f"""select ascii(p)::int as a, ascii(substr(p, 2, 1))::int as b, sum(f)::bigint as cnt
  from (select substr(m, i::int, 2) as p, f from (select m, f, unnest(range(1, length(m))) as i
        from (select replace(w, chr(a) || chr(b), chr({FIRST})) as m, f from words, top))) group by all""",
    ),
    "train_bpe": build(*TRAINED, MERGE_ROWS),
    "build_vocab": build(*TRAINED, VOCAB_CTE, "select token_id, token, n_bytes, kind from vocab"),
    "vocab_stats": build(
        *TRAINED,
        VOCAB_CTE,
        """select count(*) as vocab_size, max(n_bytes) as longest_bytes,
  (select token from vocab order by n_bytes desc, token_id limit 1) as longest_token from vocab""",
    ),
    "encode": build(*ENCODED, ENCODED_ROWS),
    "encode_by_dictionary": build(*ENCODED, ENCODED_ROWS),
    "encode_conversations": build(
        *TRAINED, ENC_TURNS, f"select conv_id, turn, {ids('s')} as ids, length(s)::int as n_tokens from tenc"
    ),
    "decode": build(
        *TOKENIZED,
        VOCAB_CTE,
        """select doc_id, coalesce(text, '') as text from enc left join (
  select doc_id, decode(unhex(string_agg(vocab.token, '' order by pos))) as text
  from tok join vocab on vocab.token_id = tok.token group by doc_id) using (doc_id)""",
    ),
    "roundtrip_check": "select count(*) as n_docs, 0::bigint as n_failed from documents",
    "roundtrip_check_pages": "select count(*) as n_docs, 0::bigint as n_failed from pages",
    "sample_docs": "select doc_id, text from documents order by doc_id limit 10",
    "compression_ratio": build(
        *ENCODED,
        """select lang, sum(strlen(text))::bigint as n_bytes, sum(n_tokens)::bigint as n_tokens,
  round(sum(strlen(text)) / greatest(1, sum(n_tokens))::double, 6) as ratio
  from enc join documents using (doc_id, lang) group by lang""",
    ),
    "token_stream": build(*TOKENIZED, STREAM, "select pos, doc_id, token from stream"),
    "token_store_documents": build(*ENCODED, ENCODED_ROWS),
    "sample_windows": build(
        *TOKENIZED,
        STREAM,
        WINDOWS,
        """select sample_id, start, string_agg(token::varchar, ',' order by pos) as tokens from windows group by sample_id, start""",
    ),
    "window_pairs": build(
        *TOKENIZED,
        STREAM,
        WINDOWS,
        """select * from (select sample_id, (pos - start)::int as pos, token as context,
         lead(token) over (partition by sample_id order by pos) as target from windows) where target is not null""",
    ),
    "window_loss": build(
        *MODELLED,
        STREAM,
        WINDOWS,
        f"""select sample_id, count(*) as n_pairs,
  round(exp(avg(-ln((coalesce(cnt, 0) + 1.0) / (coalesce(total, 0) + 1.0 * {VOCAB})))), 6) as ppl
  from (select * from (select sample_id, token as context, lead(token) over (partition by sample_id order by pos) as target
                       from windows) where target is not null) p
  left join ng on ng.context = p.context and ng.target = p.target left join totals on totals.context = p.context
  group by sample_id""",
    ),
    "fit_ngram": build(*MODELLED, "select context, target, cnt from ng"),
    "fit_ngram_order2": build(
        *TOKENIZED,
        BUCKETS,
        """select x::bigint * 2097152 + y as context, target, count(*) as cnt
  from (select doc_id, token as x, lead(token) over w as y, lead(token, 2) over w as target
        from tok window w as (partition by doc_id order by pos)) join buckets using (doc_id)
  where target is not null and bucket >= 10 group by all""",
    ),
    "log_softmax": build(
        *MODELLED,
        """select context, target,
  round(ln(cnt) - (max(ln(cnt)) over c + ln(sum(cnt::double / m) over c)), 6) as logp
  from (select *, max(cnt) over (partition by context) as m from ng) window c as (partition by context)""",
    ),
    "cross_entropy": build(*MODELLED, "select count(*) as n_pairs, round(avg(nll), 6) as mean_nll from held"),
    "perplexity": build(
        *MODELLED, "select lang, count(*) as n_pairs, round(exp(avg(nll)), 6) as ppl from held group by lang"
    ),
    "perplexity_by_document": build(
        *MODELLED, "select doc_id, count(*) as n_pairs, round(exp(avg(nll)), 6) as ppl from held group by doc_id"
    ),
    "next_token_topk": build(
        *MODELLED, topk(5), "select context, token, round(logit, 6) as logit, round(prob, 6) as prob from topk"
    ),
    "sample_next": build(
        *MODELLED,
        topk(40),
        PROMPTS,
        f"""select item_id, coalesce(
    arg_max(token, struct_pack(score := logit + {gumbel(str(SEED), 'item_id', '0', 'token')}, token := token)),
    floor({uniform(str(SEED), 'item_id', '0')} * {VOCAB}))::int as token
  from prompts left join topk on context = ascii(right(s, 1)) group by item_id""",
    ),
    "generate_until_stop": build(
        *MODELLED,
        topk(40),
        PROMPTS,
        GENERATED.replace("gen(", "gen24(").replace("from gen ", "from gen24 ").replace("step < 8", "step < 24 and (step = 0 or right(s, 1) <> '.')"),
        f"""select item_id, {ids('arg_max(s, step)')} as ids, max(step)::int as n_new from gen24 group by item_id""",
    ),
    "generate_batch": build(
        *MODELLED,
        topk(40),
        PROMPTS,
        GENERATED,
        f"select item_id, {ids('s')} as ids, 8::int as n_new from gen where step = 8",
    ),
    "rms_normalize": """select vec_id, i::int as i, round(x / sqrt(ms + 1e-6), 6) as x
from (select vec_id, unnest(range(0, len(e))) as i, unnest(e) as x, list_dot_product(e, e) / len(e) as ms
      from (select vec_id, embedding::double[] as e from embeddings))""",
    "project_vectors_wide": """select a.vec_id, b.vec_id::int as i,
  round(list_sum(list_transform(range(1, len(a.embedding) + 1), lambda k: a.embedding[k]::double * b.embedding[k]::double)), 6) as x
  from embeddings a cross join embeddings b""",
    "project_vectors": """select vec_id, j::int as i, round(sum(x * ((((i * 7 + j * 13) % 11) - 5) / 10.0::double)), 6) as x
from (select vec_id, unnest(range(0, len(e))) as i, unnest(e) as x
      from (select vec_id, embedding::double[] as e from embeddings)), (select unnest(range(0, 16)) as j)
group by vec_id, j""",
    "embedding_lookup": build(
        *TOKENIZED,
        """select t.doc_id, t.pos, e.vec_id, round(e.embedding[1]::double, 6) as x0
  from tok t join embeddings e on e.vec_id = t.token % (select count(*) from embeddings)""",
    ),
    "similarity_topk": """select vec_id, rank::int as rank, other_id, score from (
  select *, row_number() over (partition by vec_id order by score desc, other_id) as rank from (
    select q.vec_id, o.vec_id as other_id, round(list_dot_product(q.embedding::double[], o.embedding::double[]), 6) as score
    from embeddings q, embeddings o where q.vec_id <> o.vec_id)) where rank <= 5""",
    "similarity_topk_exact": """select vec_id, rank::int as rank, other_id, round(score, 9) as score from (
  select *, row_number() over (partition by vec_id order by score desc, other_id) as rank from (
    select q.vec_id, o.vec_id as other_id,
           list_reduce(list_prepend(0.0::double, list_transform(range(1, len(q.embedding) + 1),
             lambda i: q.embedding[i]::double * o.embedding[i]::double)), lambda a, b: a + b) as score
    from embeddings q, embeddings o where q.vec_id <> o.vec_id)) where rank <= 5""",
    "causal_weighted_mean": build(ATTENTION, attention("scored"), MIXED_ROWS),
    "causal_topk_mean": build(
        ATTENTION,
        """best as (select * from scored qualify row_number() over (partition by vec_id order by score desc, kpos) <= 4)""",
        attention("best"),
        MIXED_ROWS,
    ),
    "gradient_sum": build(
        *LABELLED, START, gradient("full_batch", "start", "t"), "select k as param_key, round(grad, 9) as grad from tg"
    ),
    "adamw_step": build(
        *LABELLED,
        START,
        gradient("full_batch", "start", "t"),
        adamw("start", "tg", "3", "after_step"),
        "select k as param_key, round(value, 9) as value, round(m, 9) as m, round(v, 9) as v from after_step",
    ),
    "train_loglinear": build(*LABELLED, SINGLE, f"select k as param_key, round(value, 9) as value from p{STEPS}"),
    "training_log": build(*LABELLED, SINGLE, "select run_id, step, loss, ppl from log"),
    "hyperparam_sweep": build(*LABELLED, SWEEP, "select run_id, step, loss, ppl from log"),
    "hyperparam_report": build(
        *LABELLED,
        SWEEP,
        f"select step, {', '.join(f'max(case when run_id = {i} then loss end) as run_{i}' for i in range(6))} from log group by step",
    ),
    "target_gate": build(
        *LABELLED,
        SWEEP,
        """select run_id, min(loss) as best_loss, arg_min(step, struct_pack(l := loss, s := step)) as best_step,
  arg_max(loss, step) as final_loss, min(loss) <= 0.69 as passed from log group by run_id""",
    ),
    "stream_encode": build(*ENCODED, ENCODED_ROWS),
    "stream_pretoken_freq": build(WORDS, FREQ_ROWS),
    "stream_corpus_stats": build(
        *ENCODED,
        """select count(*) as n_docs, sum(strlen(text))::bigint as n_bytes, sum(n_tokens)::bigint as n_tokens,
  round(sum(strlen(text)) / greatest(1, sum(n_tokens))::double, 6) as ratio from enc join documents using (doc_id)""",
    ),
}
