"""Preference formatting: one prompt, two completions, and what of them is trained on."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
TRAINED_ROLE = "assistant"


def _segments(turns: Column) -> Column:
    """The rendered turns as (``text``, ``trained``) in order: a head, never trained, and a body."""
    return F.flatten(
        F.transform(
            turns,
            lambda t: F.array(
                F.struct(F.concat(F.lit(START), F.coalesce(t["role"], F.lit("")), F.lit("\n")).alias("text"), F.lit(False).alias("trained")),
                F.struct(
                    F.concat(F.coalesce(t["text"], F.lit("")), F.lit(END)).alias("text"),
                    F.coalesce(t["role"] == TRAINED_ROLE, F.lit(False)).alias("trained"),
                ),
            ),
        )
    )


def segment_text(segments: Column | str) -> Column:
    segments = F.col(segments) if isinstance(segments, str) else segments
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def trained_text(segments: Column | str) -> Column:
    segments = F.col(segments) if isinstance(segments, str) else segments
    return F.array_join(F.transform(F.filter(segments, lambda s: s["trained"]), lambda s: s["text"]), "")


def preference_pairs(chosen: DataFrame, rejected: DataFrame, pair: str = "conv_id") -> DataFrame:
    """(``pair``, ``n_common``, ``prompt``, ``chosen``, ``rejected``), one row per pair.

    Both inputs have a row per turn: ``pair``, ``turn``, ``role``, ``text``. The prompt is the
    longest common prefix of the two conversations' turns (equal role and text, nulls equal),
    rendered once. ``chosen`` and ``rejected`` are what comes after it, as arrays of
    (``text``, ``trained``): joined texts give the completion, and only the texts of assistant
    turns, with their end mark, are trained on; the prompt never is.

    Turns are in order of ``turn``, then role and text, nulls first; repeated turns stay. A
    conversation missing on one side has no turns there. A null role renders as no role and
    is not trained on, a null text as empty. Equal conversations give two empty completions.
    A turn without a pair belongs to none: it is a row of its own, with an empty prompt, on the
    side it came from. Other columns are not read. No rows: no pairs.

    One shuffle by pair. A conversation is one row, as it is one training text.
    """
    turn = F.struct("turn", "role", "text")
    sides = chosen.select(F.col(pair).alias("pair"), turn.alias("c"), F.lit(None).cast("struct<turn:bigint,role:string,text:string>").alias("r")).unionAll(
        rejected.select(F.col(pair), F.lit(None).cast("struct<turn:bigint,role:string,text:string>"), turn)
    )
    paired = sides.where("pair IS NOT NULL").groupBy("pair")
    both = paired.agg(F.sort_array(F.collect_list("c")).alias("c"), F.sort_array(F.collect_list("r")).alias("r"))
    lone = [F.filter(F.array(side), lambda t: t.isNotNull()).alias(side) for side in "cr"]
    both = both.unionAll(sides.where("pair IS NULL").select("pair", *lone))
    # Turns that only one conversation has stand against a null turn.
    same = F.zip_with(
        "c", "r", lambda c, r: c.isNotNull() & r.isNotNull() & c["role"].eqNullSafe(r["role"]) & c["text"].eqNullSafe(r["text"])
    )
    differs = F.array_position(same, False)
    found = both.withColumn("n_common", F.when(differs > 0, differs - 1).otherwise(F.size("c")).cast("int"))
    rest = lambda side: F.slice(side, F.col("n_common") + 1, F.size(side))
    return found.select(
        F.col("pair").alias(pair),
        F.size("c").cast("long").alias("n_turns"),
        F.col("n_common").cast("long").alias("n_common"),
        segment_text(_segments(F.slice("c", F.lit(1), F.col("n_common")))).alias("prompt"),
        _segments(rest("c")).alias("chosen"),
        _segments(rest("r")).alias("rejected"),
    )


def swapped_replies(turns: DataFrame, pair: str = "conv_id") -> DataFrame:
    """Each conversation with the last assistant turn's text of its neighbour in place of its own.

    Neighbours are the ids 2k and 2k + 1. Where the neighbour has no such turn, the turn goes.
    A conversation without one stays as it is, and so does one without an id.
    """
    reply = F.max(F.when(F.col("role") == TRAINED_ROLE, F.struct("turn", "text")))
    last = turns.groupBy(F.col(pair).alias("id")).agg(reply.alias("reply")).where(F.col("reply").isNotNull() & F.col("id").isNotNull())
    neighbour = last.select(F.col("id").bitwiseXOR(F.lit(1)).alias("id"), F.col("reply.text").alias("other"), F.lit(True).alias("found"))
    swaps = last.select("id", F.col("reply.turn").alias("at"), F.col("reply.text").alias("own")).join(neighbour, "id", "left")
    joined = turns.select(pair, "turn", "role", "text").join(swaps, F.col(pair) == F.col("id"), "left")
    replaced = F.coalesce(
        (F.col("role") == TRAINED_ROLE) & F.col("turn").eqNullSafe(F.col("at")) & F.col("text").eqNullSafe(F.col("own")), F.lit(False)
    )
    return joined.where(~replaced | F.col("found").isNotNull()).select(
        pair, "turn", "role", F.when(replaced, F.col("other")).otherwise(F.col("text")).alias("text")
    )


ORACLE = f"""
WITH last AS (
  SELECT conv_id, max({{'turn': turn, 'text': text}}) AS reply FROM conversations WHERE role = '{TRAINED_ROLE}' GROUP BY conv_id
), swaps AS (
  SELECT l.conv_id, l.reply.turn AS at_turn, l.reply.text AS own, n.reply.text AS other, n.conv_id IS NOT NULL AS found
  FROM last l LEFT JOIN last n ON n.conv_id = xor(l.conv_id, 1)
), other_turns AS (
  SELECT c.conv_id, c.turn, c.role,
         CASE WHEN c.role = '{TRAINED_ROLE}' AND c.turn = s.at_turn AND c.text IS NOT DISTINCT FROM s.own THEN s.other ELSE c.text END AS text
  FROM conversations c LEFT JOIN swaps s ON c.conv_id = s.conv_id
  WHERE NOT coalesce(c.role = '{TRAINED_ROLE}' AND c.turn = s.at_turn AND c.text IS NOT DISTINCT FROM s.own AND NOT s.found, false)
), a AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n FROM conversations
), b AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n FROM other_turns
), compared AS (
  SELECT coalesce(a.conv_id, b.conv_id) AS conv_id, coalesce(a.n, b.n) AS n, a.role AS a_role, a.text AS a_text, a.n IS NOT NULL AS in_a,
         b.role AS b_role, b.text AS b_text, b.n IS NOT NULL AS in_b,
         a.n IS NOT NULL AND b.n IS NOT NULL AND a.role IS NOT DISTINCT FROM b.role AND a.text IS NOT DISTINCT FROM b.text AS same
  FROM a FULL JOIN b ON a.conv_id = b.conv_id AND a.n = b.n
), marked AS (
  SELECT *, n < coalesce(min(CASE WHEN same THEN NULL ELSE n END) OVER (PARTITION BY conv_id), 1000000000) AS common FROM compared
), rendered AS (
  SELECT *, '{START}' || coalesce(a_role, '') || chr(10) || coalesce(a_text, '') || '<|im_end|>' || chr(10) AS a_out,
         '{START}' || coalesce(b_role, '') || chr(10) || coalesce(b_text, '') || '<|im_end|>' || chr(10) AS b_out
  FROM marked
)
SELECT conv_id, count(*) FILTER (WHERE in_a) AS n_turns, count(*) FILTER (WHERE common) AS n_common,
       sha256(coalesce(string_agg(a_out, '' ORDER BY n) FILTER (WHERE common), '')) AS prompt_sha256,
       sha256(coalesce(string_agg(a_out, '' ORDER BY n) FILTER (WHERE in_a AND NOT common), '')) AS chosen_sha256,
       sha256(coalesce(string_agg(b_out, '' ORDER BY n) FILTER (WHERE in_b AND NOT common), '')) AS rejected_sha256,
       sha256(coalesce(string_agg(coalesce(a_text, '') || '<|im_end|>' || chr(10), '' ORDER BY n)
              FILTER (WHERE in_a AND NOT common AND a_role = '{TRAINED_ROLE}'), '')) AS chosen_trained_sha256,
       sha256(coalesce(string_agg(coalesce(b_text, '') || '<|im_end|>' || chr(10), '' ORDER BY n)
              FILTER (WHERE in_b AND NOT common AND b_role = '{TRAINED_ROLE}'), '')) AS rejected_trained_sha256
FROM rendered WHERE conv_id IS NOT NULL GROUP BY conv_id
UNION ALL
SELECT conv_id, CAST(in_a AS BIGINT), 0, sha256(''), sha256(CASE WHEN in_a THEN a_out ELSE '' END), sha256(CASE WHEN in_b THEN b_out ELSE '' END),
       sha256(CASE WHEN in_a AND a_role = '{TRAINED_ROLE}' THEN coalesce(a_text, '') || '<|im_end|>' || chr(10) ELSE '' END),
       sha256(CASE WHEN in_b AND b_role = '{TRAINED_ROLE}' THEN coalesce(b_text, '') || '<|im_end|>' || chr(10) ELSE '' END)
FROM rendered WHERE conv_id IS NULL
"""
