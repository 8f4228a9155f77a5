"""Registered queries: row identity, splits, sharding (Q*, P7-P9, F11) and
vocabularies (A14, T1, T3-T6, J3, J6, A16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import text as tx
from quire.operators import order as od
from quire.operators import permute as pm
from quire.operators import vocab as vc
from quire.plans import sqlkit as S
from quire.plans.catalog import r6, register
from quire.plans.queries_more import UNK, _ws_sql, conv_vocab
from quire.plans.standins import table


def _perm_sql(src: str, key: str, seed: int, name: str = "p") -> str:
    return f"row_number() OVER (ORDER BY md5('{seed}:' || CAST({key} AS VARCHAR)), {key}) - 1 AS {name}"


# ------------------------------------------------------------ row order ---

@register("row_index", sql="""
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_idx FROM orders""")
def row_index(spark, sf):
    """Q2: dense global index by (o_orderdate, o_orderkey) without a
    single-partition window."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return od.with_row_index(o, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "row_idx")


@register("row_index_grouped", sql="""
SELECT c_custkey, c_mktsegment,
       row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal, c_custkey) - 1 AS row_idx
FROM customer""")
def row_index_grouped(spark, sf):
    """Q2 per group: the index restarts in every market segment (a handful
    of huge groups: bucketed, not one task per group)."""
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return od.with_row_index(c, ["c_acctbal", "c_custkey"], ["c_mktsegment"]).select("c_custkey", "c_mktsegment", "row_idx")


@register("take_first", sql="""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS o_orderdate
FROM orders ORDER BY orders.o_orderdate, o_orderkey LIMIT 1000""")
def take_first(spark, sf):
    """The first 1000 rows in order (the limit is the operator); the
    timestamp is rendered as text so both engines compare it exactly."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    t = od.take_first(o, 1000, ["o_orderdate", "o_orderkey"])
    return t.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("o_orderdate"))


PCT = 5


@register("percent_split", sql=f"""
WITH n AS (SELECT count(*) AS n FROM documents)
SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY doc_id) - 1 < round_even({PCT} * n / 100.0, 0)
                    THEN 'validation' ELSE 'train' END AS split
FROM documents, n""")
def percent_split(spark, sf):
    """validation = first 5% by doc_id, train = the rest."""
    d = table(spark, sf, "documents").select("doc_id")
    return od.head_percent_split(d, PCT, ["doc_id"])


@register("split_manifest", sql=f"""
WITH n AS (SELECT count(*) AS n FROM documents),
s AS (SELECT text, CASE WHEN row_number() OVER (ORDER BY doc_id) - 1 < round_even({PCT} * n / 100.0, 0)
                   THEN 'validation' ELSE 'train' END AS split FROM documents, n)
SELECT split, count(*) AS num_examples, CAST(sum(octet_length(encode(text))) AS BIGINT) AS num_bytes
FROM s GROUP BY split""")
def split_manifest(spark, sf):
    """rows and UTF-8 bytes per split."""
    from quire.sources.sinks import split_manifest as manifest
    d = table(spark, sf, "documents").select("doc_id", "text")
    return manifest(od.head_percent_split(d, PCT, ["doc_id"]), "text")


@register("shuffle_perm", sql=f"SELECT doc_id, {_perm_sql('documents', 'doc_id', 42, 'perm_idx')} FROM documents")
def shuffle_perm(spark, sf):
    """Seeded permutation index, independent of partitioning."""
    d = table(spark, sf, "documents").select("doc_id")
    return od.shuffled_index(d, "doc_id", 42)


BATCH, GSTEP = 64, 30


@register("batches", sql=f"""
WITH i AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx FROM orders),
n AS (SELECT count(*) AS n FROM orders),
b AS (SELECT o_orderkey, idx // {BATCH} AS batch, n FROM i, n)
SELECT o_orderkey, batch FROM b
WHERE batch < n // {BATCH} AND batch >= ({GSTEP} % (n // {BATCH}))""")
def batches(spark, sf):
    """Q3 + Q1 + Q9: batch ids, drop the short tail, skip the batches a
    resumed run has already seen (global step 30, one epoch = full batches)."""
    o = table(spark, sf, "orders").select("o_orderkey")
    n = o.count()
    i = od.with_row_index(o, ["o_orderkey"], name="idx").withColumn("batch", od.assign_batches("idx", BATCH))
    full = od.drop_last(i, "idx", BATCH, n)
    _, rest = od.resume_skip(full, "batch", GSTEP, n // BATCH)
    return rest.select("o_orderkey", "batch")


def _wrap_sql(perm_cte: str, world_total: str) -> str:
    return f"""
{perm_cte},
n AS (SELECT count(*) AS n FROM documents),
t AS (SELECT n, {world_total} AS tot FROM n),
w AS (SELECT doc_id, p + k * n AS pos FROM perm, t, (SELECT unnest(range(0, 4)) AS k) ks WHERE p + k * n < tot)"""


@register("shards_round_robin", sql="WITH " + _wrap_sql(
    f"perm AS (SELECT doc_id, {_perm_sql('documents', 'doc_id', 43)} FROM documents)",
    "CAST(ceil(n / 3.0) * 3 AS BIGINT)") + """
SELECT doc_id, pos, pos % 3 AS shard FROM w""")
def shards_round_robin(spark, sf):
    """Q4: world 3, seed 42 + epoch 1, tail wrapped."""
    d = table(spark, sf, "documents").select("doc_id")
    return od.shard_round_robin(d, "doc_id", 3, seed=42, epoch=1).select("doc_id", "pos", "shard")


def _network_sql(seed: int) -> str:
    """One pass of the network over the column v of a relation with n, a, b
    (a macro of nested selects), as a subquery text with {src} open."""
    inner = "SELECT id, n, a, b, v // b AS l, v % b AS r FROM {src}"
    for k, (m, c) in enumerate(pm.round_keys(seed)):
        size = "a" if k % 2 == 0 else "b"
        inner = (f"SELECT id, n, a, b, r AS l, (l + (t * t) % {pm.PRIME}) % {size} AS r "
                 f"FROM (SELECT *, (r * {m} + {c}) % {pm.PRIME} AS t FROM ({inner}))")
    return f"SELECT id, n, a, b, l * b + r AS v FROM ({inner})"


def _permuted_sql(seed: int, name: str) -> str:
    net = _network_sql(seed)
    return f"""
{name}_walk AS (
  {net.format(src="indexed")}
  UNION ALL
  {net.format(src=f"(SELECT * FROM {name}_walk WHERE v >= n)")}),
{name} AS (SELECT id, n, v AS p FROM {name}_walk WHERE v < n)"""


INDEXED_SQL = """
indexed AS (SELECT o_orderkey AS id, n, a, CAST(ceil(n / CAST(a AS DOUBLE)) AS BIGINT) AS b, v FROM (
  SELECT o_orderkey, n, CAST(ceil(sqrt(n)) AS BIGINT) AS a, row_number() OVER (ORDER BY o_orderkey) - 1 AS v
  FROM orders, (SELECT count(*) AS n FROM orders)))"""


@register("epoch_permutation", sql=f"WITH RECURSIVE {INDEXED_SQL}, {_permuted_sql(42, 'e0')}, {_permuted_sql(43, 'e1')}" + """
SELECT e0.id AS o_orderkey, e0.p AS epoch0, e1.p AS epoch1 FROM e0 JOIN e1 USING (id)""")
def epoch_permutation(spark, sf):
    """P9 by a keyed permutation: the orders are indexed once, the places of
    two epochs are projections of that index."""
    indexed = od.with_row_index(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], name="idx")
    n = indexed.count()
    return indexed.select("o_orderkey", pm.keyed_index("idx", n, 42).alias("epoch0"),
                          pm.keyed_index("idx", n, 43).alias("epoch1"))


def _epoch_wrap_sql(block: int) -> str:
    return f"""
w AS (SELECT id, p + k * n AS pos FROM e1, (SELECT unnest(range(0, {block})) AS k)
      WHERE p + k * n < CAST(ceil(n / {block}.0) * {block} AS BIGINT))"""


@register("epoch_shards", sql=f"WITH RECURSIVE {INDEXED_SQL}, {_permuted_sql(43, 'e1')}, {_epoch_wrap_sql(7)}" + """
SELECT id AS o_orderkey, pos, pos % 7 AS shard FROM w""")
def epoch_shards(spark, sf):
    """Q4 by a keyed permutation: seven shards of epoch 1, the tail wrapped."""
    indexed = od.with_row_index(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], name="idx")
    return pm.epoch_shards(indexed, "idx", indexed.count(), 7, seed=42, epoch=1).select("o_orderkey", "pos", "shard")


@register("epoch_loop_shards", sql=f"WITH RECURSIVE {INDEXED_SQL}, {_permuted_sql(43, 'e1')}, {_epoch_wrap_sql(96)}" + """
SELECT id AS o_orderkey, pos, (pos // 32) % 3 AS shard FROM w""")
def epoch_loop_shards(spark, sf):
    """Q6 by a keyed permutation: three shards of full batches of 32."""
    indexed = od.with_row_index(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], name="idx")
    out = pm.epoch_loop_shards(indexed, "idx", indexed.count(), 3, 32, seed=42, epoch=1)
    return out.select("o_orderkey", "pos", "shard")


@register("shards_blocks", sql="WITH " + _wrap_sql(
    "perm AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS p FROM documents)",
    "CAST(ceil(n / 64.0) * 64 AS BIGINT)") + """
SELECT doc_id, pos, (pos // 16) % 4 AS shard FROM w""")
def shards_blocks(spark, sf):
    """Q5: evaluation shards in blocks of 16 over 4 workers."""
    d = table(spark, sf, "documents").select("doc_id")
    i = od.with_row_index(d, ["doc_id"], name="idx")
    return od.shard_blocks(i, "idx", 4, 16).select("doc_id", "pos", "shard")


@register("loop_shards", sql="WITH " + _wrap_sql(
    f"perm AS (SELECT doc_id, {_perm_sql('documents', 'doc_id', 7)} FROM documents)",
    "CAST(ceil(n / 24.0) * 24 AS BIGINT)") + """
SELECT doc_id, pos, (pos // 8) % 3 AS shard FROM w""")
def loop_shards(spark, sf):
    """Q6: every batch full (b = 8, world = 3), seeded permutation."""
    d = table(spark, sf, "documents").select("doc_id")
    return od.loop_shards(d, "doc_id", 3, 8, seed=7).select("doc_id", "pos", "shard")


@register("length_groups", sql=f"""
WITH n AS (SELECT count(*) AS n FROM documents),
m AS (SELECT CASE WHEN least(n // 32, 50) = 0 THEN 1 ELSE least(n // 32, 50) END * 8 AS m FROM n),
perm AS (SELECT doc_id, n_chars, {_perm_sql('documents', 'doc_id', 11)} FROM documents),
r AS (SELECT doc_id, n_chars, p // m AS mega, m FROM perm, m),
ranked AS (SELECT doc_id, n_chars, mega, m,
             mega * m + row_number() OVER (PARTITION BY mega ORDER BY n_chars DESC, p) - 1 AS pos
           FROM (SELECT r.*, perm.p FROM r JOIN perm USING (doc_id))),
best AS (SELECT arg_min(pos, (-n_chars, mega)) AS b FROM ranked WHERE pos = mega * m)
SELECT doc_id, CASE WHEN pos = 0 THEN b WHEN pos = b THEN 0 ELSE pos END AS pos FROM ranked, best""")
def length_groups(spark, sf):
    """Q7: mega-batches of a seeded permutation sorted by length."""
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    return od.length_groups(d, "doc_id", F.col("n_chars"), 8, seed=11).select("doc_id", "pos")


@register("gather_pad", sql="""
WITH a AS (SELECT conv_id, turn, list_transform(string_split(text, ' '), lambda w: length(w)) AS arr FROM conversations),
w AS (SELECT max(len(arr)) AS w FROM a)
SELECT conv_id, turn, array_to_string(list_concat(arr, list_transform(range(w - len(arr)), lambda k: -100)), ' ') AS padded
FROM a, w""")
def gather_pad(spark, sf):
    """Q10: arrays padded with -100 to the global width (one scalar)."""
    c = table(spark, sf, "conversations")
    a = c.select("conv_id", "turn", F.transform(F.split("text", " "), lambda w: F.length(w)).alias("arr"))
    a = a.withColumn("rid", F.concat_ws(":", "conv_id", "turn"))
    return od.gather_pad(a, "arr", "rid").select("conv_id", "turn", F.array_join("arr", " ").alias("padded"))


# ---------------------------------------------------------- vocabularies ---

WF_SQL = f"""wf AS (SELECT w AS word, count(*) AS freq FROM (SELECT unnest({_ws_sql('text')}) AS w FROM documents) GROUP BY w)"""


@register("word_freq", sql=f"WITH {WF_SQL} SELECT word, freq FROM wf")
def word_freq(spark, sf):
    """Word counts over the whole document table."""
    return vc.word_freq(table(spark, sf, "documents"), "text")


@register("top_words", sql=f"""
WITH {WF_SQL}
SELECT word, freq, row_number() OVER (ORDER BY freq DESC, word) - 1 AS rank FROM wf
ORDER BY freq DESC, word LIMIT 1000""")
def top_words(spark, sf):
    """The 1000 most frequent words (ties by word)."""
    from pyspark.sql import Window
    t = vc.top_words(vc.word_freq(table(spark, sf, "documents"), "text"), 1000)
    return t.select("word", "freq", (F.row_number().over(Window.orderBy(F.desc("freq"), "word")) - 1).alias("rank"))


def _lang_top_sql(lang: str, k: int, name: str) -> str:
    return f"""{name} AS (SELECT word, rk FROM (
  SELECT w AS word, row_number() OVER (ORDER BY count(*) DESC, w) - 1 AS rk
  FROM (SELECT unnest({_ws_sql('text')}) AS w FROM documents WHERE lang = '{lang}') GROUP BY w) WHERE rk < {k})"""


def _lang_top(freq, lang: str, k: int):
    """(id, piece) of the k most frequent words of a language; the window is
    over k rows."""
    from pyspark.sql import Window
    t = vc.top_words(freq.where(F.col("lang") == lang).select("word", "freq"), k)
    return t.select((F.row_number().over(Window.orderBy(F.desc("freq"), "word")) - 1).cast("long").alias("id"),
                    F.col("word").alias("piece"))


@register("vocab_merge", sql=f"""
WITH {_lang_top_sql('en', 400, 'base')}, {_lang_top_sql('de', 400, 'dom')}, {_lang_top_sql('fr', 300, 'topw')},
{WF_SQL},
d AS (SELECT word AS piece, rk AS o FROM dom WHERE word NOT IN (SELECT word FROM base)),
c AS (SELECT DISTINCT word AS piece FROM wf
      WHERE regexp_full_match(word, '{S.HAN}*') AND word NOT IN (SELECT word FROM base)
        AND word NOT IN (SELECT piece FROM d)),
t AS (SELECT word AS piece, rk AS o FROM topw WHERE word NOT IN (SELECT word FROM base)
        AND word NOT IN (SELECT piece FROM d) AND word NOT IN (SELECT piece FROM c)),
allp AS (SELECT word AS piece, 'base' AS origin, 0 AS step, rk AS o FROM base
         UNION ALL SELECT piece, 'domain', 1, o FROM d
         UNION ALL SELECT piece, 'cjk', 2, 0 FROM c
         UNION ALL SELECT piece, 'top', 3, o FROM t)
SELECT row_number() OVER (ORDER BY step, o, piece) - 1 AS id, piece, origin FROM allp""")
def vocab_merge(spark, sf):
    """T6 + J3/U4 + P13: base = top English words, domain = top German
    words, all-Han words of the corpus, then top French words; each step
    adds only unseen pieces."""
    from quire.session import cut_lineage
    freq = cut_lineage(vc.word_freq_by(table(spark, sf, "documents"), "lang"))  # one scan for all four lists
    base = _lang_top(freq, "en", 400).select("id", "piece", F.lit(0.0).alias("score"))
    dom = _lang_top(freq, "de", 400)
    words = freq.select("word").distinct()
    top = _lang_top(freq, "fr", 300).select(F.col("piece").alias("word"), F.col("id").alias("rank"))
    merged = vc.merge_vocab(base, dom, words, top, base_rows=400, domain_rows=400)
    return merged.select("id", "piece", "origin")


@register("encode_decode", sql=f"""
WITH {__import__('quire.plans.queries_more', fromlist=['VOCAB_SQL']).VOCAB_SQL},
src AS (SELECT conv_id, turn, text FROM conversations),
{__import__('quire.plans.queries_more', fromlist=['_encode_sql'])._encode_sql('enc', 'src', ['conv_id', 'turn'], 'text')},
pos AS (SELECT conv_id, turn, unnest(ids) AS id, generate_subscripts(ids, 1) AS i FROM enc),
dec AS (SELECT p.conv_id, p.turn, string_agg(coalesce(v.piece, ''), ' ' ORDER BY p.i) AS txt
        FROM pos p LEFT JOIN (SELECT piece, id FROM vocab UNION ALL SELECT '<unk>', {UNK}) v ON p.id = v.id
        WHERE p.id NOT IN (0, 2, 3, 4) GROUP BY p.conv_id, p.turn)
SELECT e.conv_id, e.turn, len(e.ids) AS n_ids, len(list_filter(e.ids, lambda x: x = {UNK})) AS n_unk,
       coalesce(d.txt, '') AS decoded
FROM enc e LEFT JOIN dec d USING (conv_id, turn)""")
def encode_decode(spark, sf):
    """J6 + E10 (+T4/T5 word level): encode every turn with the word
    vocabulary, decode skipping special ids except unknown."""
    c = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    v = conv_vocab(spark, sf)
    e = vc.encode(c, ["conv_id", "turn"], vc.ws_tokens("text"), v, UNK, "ids")
    dd = vc.decode(e, ["conv_id", "turn"], "ids", v, skip_ids=(0, 2, 3, 4), out="decoded")
    return dd.select("conv_id", "turn", F.size("ids").alias("n_ids"),
                     F.size(F.filter("ids", lambda x: x == UNK)).alias("n_unk"), "decoded")


@register("fertility", sql=f"""
WITH {_lang_top_sql('en', 400, 'base')}, {_lang_top_sql('de', 400, 'dom')},
newv AS (SELECT word FROM base UNION SELECT word FROM dom),
toks AS (SELECT lang, unnest({_ws_sql('text')}) AS piece FROM documents)
SELECT lang,
  round(sum(CASE WHEN piece IN (SELECT word FROM base) THEN 1 ELSE length(piece) END)::DOUBLE / count(*), 6) AS fertility_old,
  round(sum(CASE WHEN piece IN (SELECT word FROM newv) THEN 1 ELSE length(piece) END)::DOUBLE / count(*), 6) AS fertility_new
FROM toks GROUP BY lang""")
def fertility(spark, sf):
    """Tokens per word by language before and after adding the
    German top words to the English base vocabulary."""
    from quire.session import cut_lineage
    freq = cut_lineage(vc.word_freq_by(table(spark, sf, "documents"), "lang"))
    base = _lang_top(freq, "en", 400)
    new = base.unionByName(_lang_top(freq, "de", 400))
    f = vc.fertility(freq, "lang", {"fertility_old": base, "fertility_new": new}, vocab_rows=800)
    return f.select("lang", r6(F.col("fertility_old")).alias("fertility_old"), r6(F.col("fertility_new")).alias("fertility_new"))


def _pretok_sql(t: str) -> str:
    sp = vc.SP_SPACE
    return f"regexp_extract_all('{sp}' || replace({t}, ' ', '{sp}'), {S.lit('(?s)(' + vc.pretoken_pattern('') + ')')}, 1)"


LINES_SQL = "l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)"


@register("bpe_pair_counts", sql=f"""
WITH {LINES_SQL}, pt AS (SELECT unnest({_pretok_sql('line')}) AS word FROM l WHERE line <> ''),
w AS (SELECT word, count(*) AS freq FROM pt GROUP BY word),
s AS (SELECT freq, regexp_extract_all(word, '(?s)(.)', 1) AS syms FROM w),
p AS (SELECT freq, unnest(list_zip(syms[1:len(syms) - 1], syms[2:])) AS lr FROM s WHERE len(syms) >= 2)
SELECT lr[1] AS l, lr[2] AS r, CAST(sum(freq) AS BIGINT) AS cnt FROM p GROUP BY lr[1], lr[2]""")
def bpe_pair_counts(spark, sf):
    """T3 round one: weighted adjacent-pair counts over the distinct
    pre-tokens of every line (NFKC, marker, digit/script splits): the whole
    table of pairs."""
    return vc.pair_counts(vc.bpe_words(table(spark, sf, "documents"), "text"))


VOCAB_SIZE = 2236  # the reference's


@register("bpe_merges")
def bpe_merges(spark, sf):
    """T3 (exact mode): the merges of a vocabulary of 2236 pieces over the
    documents. Checked in pytest against a naive BPE that recounts all pairs."""
    return vc.train_vocab(table(spark, sf, "documents"), VOCAB_SIZE, "text")[1]


@register("bpe_merges_batched")
def bpe_merges_batched(spark, sf):
    """T3 batched mode: as many merges, up to 32 pairs that share no symbol
    taken at once."""
    return vc.train_vocab(table(spark, sf, "documents"), VOCAB_SIZE, "text", merges_per_round=32)[1]


@register("bpe_vocab")
def bpe_vocab(spark, sf):
    """A vocabulary of 2236 pieces (specials, 256 bytes, merges of the
    documents, their characters). Checked in pytest."""
    vocab, _ = vc.train_vocab(table(spark, sf, "documents"), VOCAB_SIZE, "text")
    return vocab.select("id", "piece", "origin")


@register("bpe_encode")
def bpe_encode(spark, sf):
    """T4 + T5: every line of every document to pieces and ids with a
    vocabulary learned on the documents, and back; ``round_trip`` compares
    with the normalised line."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    vocab, merges = vc.train_vocab(docs, VOCAB_SIZE, "text")
    enc = vc.bpe_encode_texts(docs, ["doc_id"], merges, vocab)
    lines = vc.text_lines(docs, "text", keep=["doc_id"]).select("doc_id", "line_no", vc.nfkc()(F.col("line")).alias("line"))
    told = enc.select(
        "doc_id", "line_no", F.size("pieces").alias("n_pieces"), F.size("ids").alias("n_ids"),
        F.size(F.filter("ids", lambda x: x.isNull())).alias("n_missing"), vc.decode_byte_pieces(F.col("pieces")).alias("decoded"))
    return told.join(lines, ["doc_id", "line_no"]).select(
        "doc_id", "line_no", "n_pieces", "n_ids", "n_missing",
        (F.col("decoded") == F.regexp_replace("line", vc.SP_SPACE, " ")).alias("round_trip"))


@register("decode_pieces", sql="""
SELECT doc_id, md5(text) AS decoded_md5 FROM documents""")
def decode_pieces(spark, sf):
    """T5: the characters of every text as pieces (marker for a space, one
    leading marker) decode to the text."""
    d = table(spark, sf, "documents")
    marked = F.concat(F.lit(vc.SP_SPACE), F.replace(F.col("text"), F.lit(" "), F.lit(vc.SP_SPACE)))
    return d.select("doc_id", F.md5(vc.decode_pieces(tx.chars(marked))).alias("decoded_md5"))


@register("bpe_skipped_lines", sql=f"""
WITH {LINES_SQL}
SELECT count(*) AS lines, CAST(coalesce(sum(octet_length(encode(line))), 0) AS BIGINT) AS bytes
FROM l WHERE line <> '' AND octet_length(encode(line)) > 16384""")
def bpe_skipped_lines(spark, sf):
    """What the reference's limit of 16384 bytes a line would leave out
    (reported; nothing is left out here)."""
    return vc.skipped_lines(table(spark, sf, "documents"), 16384)
