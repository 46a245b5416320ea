"""Byte-level token ids (B1-B4) as native array expressions.

Fixed values of the byte vocabulary: pad = 0, eos = 1, unk = 2, byte b → b + 3 (so the 256 byte
ids lie between unk and the first extra id 259); sequences are cut to ``max_len - 1`` bytes, get
the eos id, and are padded with pad ids to ``max_len``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .regex import bound, q

PAD, EOS, UNK, OFFSET, FIRST_EXTRA = 0, 1, 2, 3, 259
# The strings of the special tokens: pad, eos, unk and 125 extra ids.
SPECIAL = "<pad>|</s>|<unk>|<extra_id_(?:[0-9]|[1-9][0-9]|1[01][0-9]|12[0-4])>"
MAX_LEN = 512


def _bytes(raw: Column) -> Column:
    """Ids of a binary value: two hex digits per byte; the lambda only sees its own element."""
    return F.transform(F.regexp_extract_all(F.hex(raw), F.lit(".."), 0), lambda h: F.conv(h, 16, 10).cast("int") + OFFSET)


def _special_id(token: Column) -> Column:
    return (F.when(token == "<pad>", PAD).when(token == "</s>", EOS).when(token == "<unk>", UNK)
            .otherwise(F.regexp_extract(token, "([0-9]+)", 1).cast("int") + FIRST_EXTRA).cast("int"))


def byte_ids(text: Column, max_len: int | None = MAX_LEN) -> Column:
    """UTF-8 bytes + 3 with special-token strings as their own ids, truncated to ``max_len - 1``, then
    eos (unless the text ends with it), then pad to ``max_len`` (None: the whole text, no padding)."""
    t = F.coalesce(text, F.lit(""))
    raw = F.encode(t, "UTF-8")
    parts, tokens = F.split(t, SPECIAL, -1), F.regexp_extract_all(t, F.lit(SPECIAL), 0)
    mixed = F.flatten(F.transform(parts, lambda x, i: F.concat(
        _bytes(F.encode(x, "UTF-8")),
        F.when(i < F.size(tokens), F.array(_special_id(F.get(tokens, i)))).otherwise(F.array().cast("array<int>")))))
    if max_len is None:
        ids = F.when(t.rlike(SPECIAL), mixed).otherwise(_bytes(raw))
        return bound(ids, lambda x: F.when(F.get(x, F.size(x) - 1) == EOS, x).otherwise(F.concat(x, F.array(F.lit(EOS)))))
    keep = max_len - 1
    plain = _bytes(F.substring(raw, 1, keep))  # without specials only the first bytes are looked at

    def closed(ids: Column) -> Column:
        pad = F.array_repeat(F.lit(PAD), F.lit(keep) - F.size(ids))
        return F.concat(ids, F.array(F.lit(EOS)), pad)

    def special(ids: Column) -> Column:
        body = F.when(F.get(ids, F.size(ids) - 1) == EOS, F.slice(ids, 1, F.size(ids) - 1)).otherwise(ids)
        return closed(F.slice(body, 1, keep))

    return F.when(t.rlike(SPECIAL), special(mixed)).otherwise(closed(plain))


def attention_mask(ids: Column) -> Column:
    return F.transform(ids, lambda t: F.when(t == PAD, 0).otherwise(1))


def byte_ids_sql(e: str, max_len: int = MAX_LEN) -> str:
    """DuckDB twin via hex text (bytes are read two hex digits at a time); for texts without
    special-token strings."""
    keep = max_len - 1
    hx = f"left(hex(encode(coalesce({e}, ''))), {2 * keep})"
    ids = (f"list_transform(range(CAST(length({hx}) / 2 AS BIGINT)), "
           f"lambda i_: CAST(('0x' || substring({hx}, CAST(i_ * 2 + 1 AS BIGINT), 2)) AS INTEGER) + {OFFSET})")
    body = f"list_concat({ids}, [{EOS}])"
    return f"list_concat({body}, list_transform(range({max_len} - len({body})), lambda z_: {PAD}))"


def special_ids_sql(e: str, max_len: int = MAX_LEN) -> str:
    """DuckDB twin for texts with special-token strings: the parts between them as bytes, each followed by its token."""
    keep = max_len - 1
    hx = "hex(encode(p_[k_]))"
    raw = (f"list_transform(range(CAST(length({hx}) / 2 AS BIGINT)), "
           f"lambda i_: CAST(('0x' || substring({hx}, CAST(i_ * 2 + 1 AS BIGINT), 2)) AS INTEGER) + {OFFSET})")
    token = (f"CASE s_[k_] WHEN '<pad>' THEN {PAD} WHEN '</s>' THEN {EOS} WHEN '<unk>' THEN {UNK} "
             f"ELSE CAST(regexp_extract(s_[k_], '[0-9]+') AS INTEGER) + {FIRST_EXTRA} END")
    mixed = f"flatten(list_transform(range(1, len(p_) + 1), lambda k_: CASE WHEN k_ <= len(s_) THEN list_append({raw}, {token}) ELSE {raw} END))"
    body = f"list_slice(CASE WHEN m_[-1] = {EOS} THEN m_[:-2] ELSE m_ END, 1, {keep})"
    return f"""(SELECT list_concat(list_append(b_, {EOS}), list_transform(range({keep} - len(b_)), lambda z_: {PAD})) FROM (
  SELECT {body} AS b_ FROM (SELECT {mixed} AS m_ FROM (
    SELECT regexp_split_to_array(t_, {q(SPECIAL)}) AS p_, regexp_extract_all(t_, {q(SPECIAL)}) AS s_ FROM (SELECT coalesce({e}, '') AS t_)))))"""


def attention_mask_sql(ids: str) -> str:
    return f"list_transform({ids}, lambda t_: CASE WHEN t_ = {PAD} THEN 0 ELSE 1 END)"


def decode_ids(ids: Column) -> Column:
    """Keep byte ids (pad/eos/unk and extra ids are skipped as special), bytes = id - 3, UTF-8
    decode dropping invalid sequences; a valid U+FFFD stays."""
    kept = F.filter(ids, lambda t: (t >= OFFSET) & (t < 256))
    hx = F.array_join(F.transform(kept, lambda t: F.lpad(F.hex(t - OFFSET), 2, "0")), " ")
    # EF starts a sequence wherever it stands, so valid U+FFFD can be cut out before the others
    parts = F.split(hx, "EF BF BD")
    # binary → string does not validate; make_valid_utf8 marks each bad sequence with U+FFFD
    text = F.transform(parts, lambda p: F.replace(
        F.make_valid_utf8(F.unhex(F.replace(p, F.lit(" "), F.lit(""))).cast("string")), F.lit("\ufffd"), F.lit("")))
    return F.array_join(text, "\ufffd")
