"""Training-example preparation (P*, E*): projections, filters, prompt
rendering, token layout, padding. Everything is a column expression over a
table of examples, so each operator is a narrow transformation that keeps
the input partitioning; only the batch-relative padding (E6, E8 with
``pad_to='batch'``) needs a window, partitioned by batch id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import text as tx
from quire.sources.files import require_columns

IGNORE = -100  # fixed value: label id the loss ignores

# Chat-history rendering (Chinese "question" / "answer" tags).
ROUND_TURN = "[Round {i}]\n问：{q}\n答：{a}\n"
ROUND_QUERY = "[Round {i}]\n问：{q}\n答："
# Preference text layout.
REWARD_TEXT = "Question: {q}\n\nAnswer: {a}"
REWARD_MAX_LEN = 512


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------- P ---

def prune_columns(df: DataFrame, wanted, label_names=()) -> tuple[DataFrame, list[str]]:
    """Keep wanted + label columns in dataset order; report the ignored."""
    keep = set(wanted) | set(label_names)
    cols = [c for c in df.columns if c in keep]
    ignored = [c for c in df.columns if c not in keep]
    return df.select(*cols), ignored


def keep_only(df: DataFrame, col: str = "conversations") -> DataFrame:
    """Drop every column but ``col``."""
    require_columns(df, [col])
    return df.select(col)


def rename_if_present(df: DataFrame, old: str = "items", new: str = "conversations") -> DataFrame:
    """Rename a column when present (the intended rename, D10)."""
    return df.withColumnRenamed(old, new) if old in df.columns else df


def present(c) -> Column:
    """NULL and '' both count as missing (truthiness)."""
    c = _c(c)
    return c.isNotNull() & (c != "")


def filter_complete(df: DataFrame, prompt: str = "content", response: str = "summary") -> DataFrame:
    """Drop rows with a missing prompt or response."""
    return df.where(present(prompt) & present(response))


def filter_length(df: DataFrame, cols, max_len: int) -> DataFrame:
    """P5: keep rows whose token arrays all have 0 < size <= max_len."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & (F.size(c) > 0) & (F.size(c) <= max_len)
    return df.where(cond)


def ignore_empty(df: DataFrame, hyp: str, ref: str) -> DataFrame:
    """Drop pairs where either side is ''."""
    return df.where((F.length(hyp) > 0) & (F.length(ref) > 0))


def alpaca_to_sharegpt(instruction, inp, output) -> Column:
    """P10: [human, gpt] turns; input is appended (unstripped) when its
    stripped length exceeds 1."""
    q = F.when(F.length(tx.strip_py(_c(inp))) > 1,
               F.concat(_c(instruction), F.lit("\n\n"), _c(inp))).otherwise(_c(instruction))
    return F.array(F.struct(F.lit("human").alias("from"), q.alias("value")),
                   F.struct(F.lit("gpt").alias("from"), _c(output).alias("value")))


def reward_text(question, answer) -> Column:
    """P11: 'Question: q\\n\\nAnswer: a'."""
    return F.concat(F.lit("Question: "), _c(question), F.lit("\n\nAnswer: "), _c(answer))


def with_prefix(prompt, prefix: str | None) -> Column:
    """Prepend the source prefix."""
    return F.concat(F.lit(prefix or ""), _c(prompt))


def select_mode(df: DataFrame, modes, split_col: str = "split") -> DataFrame:
    """Keep only the requested splits (prunes partitions when the
    prepared data is written partitioned by split)."""
    return df.where(F.col(split_col).isin(list(modes)))


# --------------------------------------------------------------------- E ---

def render_history(history, query) -> Column:
    """E1: '[Round i]\\n问：q\\n答：a\\n' per earlier turn, then the query."""
    h = F.coalesce(_c(history), F.array())
    turns = F.array_join(F.transform(h, lambda t, i: F.format_string(
        "[Round %d]\n问：%s\n答：%s\n", i, t["q"], t["a"])), "")
    return F.concat(turns, F.format_string("[Round %d]\n问：%s\n答：", F.size(h), _c(query)))


def build_prompt(query, history=None, mode: str = "train", prefix: str | None = None) -> Column:
    """Eval with an empty (or NULL, D8) history uses the bare query,
    train always renders rounds; without a history column both use the
    bare query. The prefix (P12) goes in front."""
    if history is None:
        p = _c(query)
    elif mode == "eval":
        p = F.when(F.coalesce(F.size(_c(history)), F.lit(0)) <= 0, _c(query)) \
            .otherwise(render_history(history, query))
    else:
        p = render_history(history, query)
    return with_prefix(p, prefix)


def truncate_head(ids, n: int) -> Column:
    """Keep the first n ids."""
    return F.slice(_c(ids), 1, n)


def keep_last(ids, k) -> Column:
    """Keep the last k ids; k <= 0 gives []."""
    ids = _c(ids)
    k = F.lit(k) if isinstance(k, int) else k
    return F.when(k <= 0, F.array().cast("array<int>")).otherwise(
        F.slice(ids, F.greatest(F.size(ids) - k + 1, F.lit(1)), k))


def build_example(prompt_ids, answer_ids, src_len: int, tgt_len: int,
                  mask_id: int, bos_id: int, eos_id: int, pad_id: int,
                  ignore_pad: bool = True) -> Column:
    """Truncate (prompt to S-1, answer to T-2), lay out
    prompt + [mask, bos] + answer + [eos], labels = -100 up to bos then the
    ids from bos on, right-pad both to S+T (label pads -> -100)."""
    a = F.slice(_c(prompt_ids), 1, src_len - 1)
    b = F.slice(_c(answer_ids), 1, tgt_len - 2)
    ids = F.concat(a, F.array(F.lit(mask_id), F.lit(bos_id)), b, F.array(F.lit(eos_id)))
    ctx = F.array_position(ids, bos_id).cast("int") - 1
    labels = F.concat(F.array_repeat(F.lit(IGNORE), ctx), F.slice(ids, ctx + 1, F.size(ids)))
    total = src_len + tgt_len
    pad_n = F.lit(total) - F.size(ids)
    ids_p = F.concat(ids, F.array_repeat(F.lit(pad_id), pad_n))
    lab_p = F.concat(labels, F.array_repeat(F.lit(pad_id), pad_n))
    if ignore_pad:
        lab_p = F.transform(lab_p, lambda l: F.when(l == pad_id, F.lit(IGNORE)).otherwise(l))
    return F.struct(ids_p.alias("input_ids"), lab_p.alias("labels"), ctx.alias("context_length"))


def pad_right(ids, width, pad_id: int) -> Column:
    ids = _c(ids)
    width = F.lit(width) if isinstance(width, int) else width
    return F.concat(ids, F.array_repeat(F.lit(pad_id), F.greatest(width - F.size(ids), F.lit(0))))


def pad_left(ids, width, pad_id: int) -> Column:
    ids = _c(ids)
    width = F.lit(width) if isinstance(width, int) else width
    return F.concat(F.array_repeat(F.lit(pad_id), F.greatest(width - F.size(ids), F.lit(0))), ids)


def eval_examples(df: DataFrame, prompt_ids: str, answer_ids: str, batch_col: str,
                  src_len: int, tgt_len: int, mask_id: int, bos_id: int, pad_id: int,
                  ignore_pad: bool = True, pad_side: str = "left") -> DataFrame:
    """Prompt truncated to S (specials [mask, bos] appended inside the
    budget), padded to the longest prompt of its batch; answer truncated to
    T, pad ids -> -100. Raw text columns are kept (filter first, D7)."""
    p = F.concat(F.slice(F.col(prompt_ids), 1, src_len - 2), F.array(F.lit(mask_id), F.lit(bos_id)))
    lab = F.slice(F.col(answer_ids), 1, tgt_len)
    if ignore_pad:
        lab = F.transform(lab, lambda l: F.when(l == pad_id, F.lit(IGNORE)).otherwise(l))
    out = df.withColumn("input_ids", p).withColumn("labels", lab)
    w = Window.partitionBy(batch_col)
    width = F.max(F.size("input_ids")).over(w)
    padder = pad_left if pad_side == "left" else pad_right
    out = out.withColumn("input_ids", padder(F.col("input_ids"), width, pad_id))
    return out.withColumn("attention_mask", F.concat(
            F.array_repeat(F.lit(0), width - F.size(p)), F.array_repeat(F.lit(1), F.size(p)))
            if pad_side == "left" else
            F.concat(F.array_repeat(F.lit(1), F.size(p)), F.array_repeat(F.lit(0), width - F.size(p))))


def reward_example(q_col: str, chosen_ids: str, rejected_ids: str, max_len: int = REWARD_MAX_LEN) -> list[Column]:
    """Truncated ids (512 by default) and attention masks of ones for
    both sides (ids of the P11 texts come from the caller's encoder)."""
    c = F.slice(F.col(chosen_ids), 1, max_len)
    r = F.slice(F.col(rejected_ids), 1, max_len)
    return [c.alias("input_ids_chosen"), F.array_repeat(F.lit(1), F.size(c)).alias("attention_mask_chosen"),
            r.alias("input_ids_rejected"), F.array_repeat(F.lit(1), F.size(r)).alias("attention_mask_rejected")]


def round_up(n: Column, multiple: int | None) -> Column:
    if not multiple:
        return n
    return (F.ceil(n / F.lit(multiple)) * F.lit(multiple)).cast("int")


def reward_collate(df: DataFrame, pad_id: int, max_length: int | None = None,
                   batch_col: str | None = None, multiple_of: int | None = None) -> DataFrame:
    """Pad ids (pad id) and masks (0) of both sides to ``max_length`` or,
    with ``batch_col``, to the longest sequence of that side in the batch;
    optionally rounded up to a multiple."""
    out = df
    for side in ("chosen", "rejected"):
        ids, mask = f"input_ids_{side}", f"attention_mask_{side}"
        if batch_col is not None:
            width = F.max(F.size(ids)).over(Window.partitionBy(batch_col))
        else:
            width = F.lit(max_length)
        width = round_up(width, multiple_of)
        out = out.withColumn(mask, pad_right(F.col(mask), width, 0)) \
                 .withColumn(ids, pad_right(F.col(ids), width, pad_id))
    return out


def mask_to_pad(labels, pad_id: int) -> Column:
    """-100 -> pad id before decoding."""
    return F.transform(_c(labels), lambda l: F.when(l == IGNORE, F.lit(pad_id)).otherwise(l))


def strip_prompt(generated, prompt_len, max_length: int | None = None, pad_id: int = 0) -> Column:
    """Drop the first len(prompt) ids of a generation, then pad."""
    g = _c(generated)
    n = F.lit(prompt_len) if isinstance(prompt_len, int) else _c(prompt_len)
    cut = F.slice(g, n + 1, F.greatest(F.size(g) - n, F.lit(0)))
    return pad_right(cut, max_length, pad_id) if max_length else cut


def render_chat(messages, system: str, roles: tuple[str, str], sep: str) -> Column:
    """Chat template as a fold over (user, assistant) turns. The
    template row is a parameter; an empty assistant text ends the prompt
    with the assistant role tag, ready for generation."""
    def turn(t):
        u = F.concat(F.lit(roles[0]), F.lit(": "), t["q"], F.lit(sep))
        a = F.when(F.length(F.coalesce(t["a"], F.lit(""))) > 0,
                   F.concat(F.lit(roles[1]), F.lit(": "), t["a"], F.lit(sep))) \
             .otherwise(F.concat(F.lit(roles[1]), F.lit(":")))
        return F.concat(u, a)
    return F.concat(F.lit(system), F.lit(sep) if system else F.lit(""),
                    F.array_join(F.transform(_c(messages), turn), ""))
