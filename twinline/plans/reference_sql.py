"""Independent DuckDB formulations of the registered queries.

Used only as the correctness oracle: plain window functions
(``row_number`` over whole tables) and a recursive CTE for greedy WordPiece,
so they share no code path with the Spark jobs.  Tables: documents,
conversations, embeddings (pre-registered views).
"""

from __future__ import annotations

# ------------------------------------------------------------- expressions

# word class of the target pre-tokeniser; whitespace = White_Space property
_W = r"\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}"
_SP = r"\t\n\x0B\f\r\x{85}\p{Z}"
WORD_PAT = "[" + _W + "]+|[^" + _W + _SP + "]+"
SPECIAL_PAT = r"\[(?:UNK|PAD|BOS|EOS)\]"
SRC_PUNCT = r"!-/:-@\[-`{-~\p{P}"
SRC_PAT = "[^" + r"\t\n\r\p{Zs}\p{Zl}\p{Zp} " + SRC_PUNCT + "]+|[" + SRC_PUNCT + "]"
CJK = (r"[\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2B73F}"
       r"\x{2B740}-\x{2B81F}\x{2B820}-\x{2CEAF}\x{F900}-\x{FAFF}\x{2F800}-\x{2FA1F}]")


def tok(x: str) -> str:
    """Target words of raw text ``x``: NFC, split out literal specials,
    lowercase the rest, word runs and punctuation runs."""
    n = f"nfc_normalize({x})"
    return (f"flatten(list_transform(string_split_regex({n}, '{SPECIAL_PAT}'), lambda seg, i: "
            f"list_concat(regexp_extract_all(lower(replace(seg, 'Σ', 'σ')), '{WORD_PAT}'), "
            f"CASE WHEN i <= len(regexp_extract_all({n}, '{SPECIAL_PAT}')) "
            f"THEN [regexp_extract_all({n}, '{SPECIAL_PAT}')[i]] ELSE [] END)))")


def plain_tok(x: str) -> str:
    """Words as the trainer sees them: literal specials are ordinary text."""
    return f"regexp_extract_all(lower(replace(nfc_normalize({x}), 'Σ', 'σ')), '{WORD_PAT}')"


def _src_segment(x: str) -> str:
    c = f"regexp_replace({x}, '[\\t\\n\\r]', ' ', 'g')"
    c = f"regexp_replace({c}, '[\\x{{0}}\\x{{FFFD}}\\p{{C}}]', '', 'g')"
    c = f"regexp_replace({c}, '[\\p{{Zs}}\\p{{Zl}}\\p{{Zp}}]', ' ', 'g')"
    c = f"regexp_replace({c}, '({CJK})', ' \\1 ', 'g')"
    return f"regexp_extract_all(lower(replace(strip_accents({c}), 'Σ', 'σ')), '{SRC_PAT}')"


def src_tok(x: str) -> str:
    """Source words: literal specials split out, then BERT-uncased clean, CJK
    spacing, strip accents, lowercase, word runs and single punctuation characters."""
    return (f"flatten(list_transform(string_split_regex({x}, '{SPECIAL_PAT}'), lambda seg, i: "
            f"list_concat({_src_segment('seg')}, "
            f"CASE WHEN i <= len(regexp_extract_all({x}, '{SPECIAL_PAT}')) "
            f"THEN [regexp_extract_all({x}, '{SPECIAL_PAT}')[i]] ELSE [] END)))")


# ------------------------------------------------------------- CTE blocks

CORPUS_LINES = """
doc_lines AS (
  SELECT doc_id, source AS corpus, lang, string_split(text, chr(10)) AS ls
  FROM documents WHERE text IS NOT NULL
),
exploded AS (
  SELECT doc_id, corpus, lang, unnest(ls) AS text, unnest(range(0, len(ls))) AS pos FROM doc_lines
),
corpus_lines AS (
  SELECT corpus, lang,
         (row_number() OVER (PARTITION BY corpus, lang ORDER BY doc_id, pos) - 1)::BIGINT AS line_no, text
  FROM exploded
),
pairs AS (
  SELECT e.corpus, e.line_no, e.text AS english, f.text AS french
  FROM corpus_lines e JOIN corpus_lines f
    ON e.corpus = f.corpus AND e.line_no = f.line_no AND e.lang = 'en' AND f.lang = 'fr'
),
split_pairs AS (
  SELECT corpus, line_no, english, french,
         CASE WHEN row_number() OVER (ORDER BY md5(concat_ws(':', '42', corpus, CAST(line_no AS VARCHAR))), corpus, line_no)
                   <= ceil(0.005::DOUBLE * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split
  FROM pairs
)"""

WORD_COUNTS = f"""
doc_words AS (
  SELECT lang, unnest({plain_tok('text')}) AS word FROM documents WHERE text IS NOT NULL
),
wc_lang AS (SELECT lang, word, count(*) AS count FROM doc_words GROUP BY lang, word)"""


def base_vocab(name: str, totals: str) -> str:
    """Specials, chars by code point, continuation chars by code point."""
    return f"""
{name}_pos AS (
  SELECT word, unnest(range(1, length(word) + 1)) AS i FROM {totals}
),
{name}_alpha AS (
  SELECT DISTINCT substring(word, i, 1) AS ch, 0 AS g FROM {name}_pos
  UNION
  SELECT DISTINCT substring(word, i, 1) AS ch, 1 AS g FROM {name}_pos WHERE i > 1
),
{name} AS (
  SELECT token, id::INT AS id FROM (VALUES ('[UNK]', 0), ('[PAD]', 1), ('[BOS]', 2), ('[EOS]', 3)) t(token, id)
  UNION ALL
  SELECT CASE WHEN g = 0 THEN ch ELSE '##' || ch END AS token,
         (3 + row_number() OVER (ORDER BY g, ch))::INT AS id
  FROM {name}_alpha
)"""


VOCAB = WORD_COUNTS + """,
totals AS (SELECT word, sum(count)::BIGINT AS count FROM wc_lang GROUP BY word),""" + base_vocab("base", "totals") + """,
topw AS (SELECT word, count FROM totals WHERE length(word) >= 2 ORDER BY count DESC, word LIMIT 2000),
vocab AS (
  SELECT token, id FROM base
  UNION ALL
  SELECT word AS token, ((SELECT count(*) FROM base) + row_number() OVER (ORDER BY count DESC, word) - 1)::INT AS id
  FROM topw WHERE word NOT IN (SELECT token FROM base)
)"""


def wordpiece(name: str, words_sql: str) -> str:
    """Greedy longest-match WordPiece of every distinct word (recursive)."""
    return f"""
{name}_words AS (SELECT DISTINCT word FROM ({words_sql})),
{name}_subs AS (
  SELECT word, s, e,
         CASE WHEN s = 1 THEN substring(word, s, e - s + 1) ELSE '##' || substring(word, s, e - s + 1) END AS piece
  FROM (SELECT word, s, unnest(range(s, length(word) + 1)) AS e
        FROM (SELECT word, unnest(range(1, length(word) + 1)) AS s FROM {name}_words WHERE length(word) <= 100))
),
{name}_lm AS (
  SELECT word, s, max(e) AS e, arg_max(id, e) AS id
  FROM {name}_subs JOIN vocab ON piece = token GROUP BY word, s
),
{name}_walk(word, s, ids) AS (
  SELECT word, 1::BIGINT, []::INTEGER[] FROM {name}_words WHERE length(word) <= 100
  UNION ALL
  SELECT w.word, (l.e + 1)::BIGINT, list_append(w.ids, l.id)
  FROM {name}_walk w JOIN {name}_lm l ON l.word = w.word AND l.s = w.s
),
{name}_enc AS (
  SELECT d.word, coalesce(k.ids, [0]::INTEGER[]) AS ids
  FROM {name}_words d
  LEFT JOIN (SELECT word, ids FROM {name}_walk WHERE s = length(word) + 1) k ON k.word = d.word
)"""


def encode_rows(name: str, rows_sql: str, keys: str, words_expr: str, trunc: int | None) -> str:
    """ids per row: [2] || wordpiece(words) (optionally first `trunc`) || [3]."""
    kk = ", ".join(f"r.{k.strip()}" for k in keys.split(","))
    ids = "coalesce(i.ids, []::INTEGER[])"
    if trunc is not None:
        ids = f"{ids}[1:{trunc}]"
    return f"""
{name}_rows AS (SELECT {keys}, {words_expr} AS ws FROM ({rows_sql})),
{name}_w AS (SELECT {keys}, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS wpos FROM {name}_rows),""" + \
        wordpiece(name + "_wp", f"SELECT word FROM {name}_w") + f""",
{name}_ids AS (
  SELECT {keys}, flatten(list(e.ids ORDER BY wpos)) AS ids
  FROM {name}_w JOIN {name}_wp_enc e USING (word) GROUP BY {keys}
),
{name} AS (
  SELECT {kk}, [2]::INTEGER[] || {ids} || [3]::INTEGER[] AS ids
  FROM {name}_rows r LEFT JOIN {name}_ids i USING ({keys})
)"""


TOKENS = CORPUS_LINES + "," + VOCAB + "," + \
    encode_rows("tgt", "SELECT corpus, line_no, french FROM split_pairs", "corpus, line_no", tok("french"), None) + "," + \
    encode_rows("src", "SELECT corpus, line_no, english FROM split_pairs", "corpus, line_no", src_tok("english"), 510) + """,
tokens_all AS (
  SELECT p.corpus, p.line_no, p.split, s.ids AS src_ids, t.ids AS tgt_ids
  FROM split_pairs p JOIN src s USING (corpus, line_no) JOIN tgt t USING (corpus, line_no)
),
tokens AS (SELECT * FROM tokens_all WHERE len(tgt_ids) > 5),
train_ranked AS (
  SELECT *, row_number() OVER (ORDER BY md5(concat_ws(':', '42', '0', corpus, CAST(line_no AS VARCHAR))), corpus, line_no) AS rk
  FROM tokens WHERE split = 'train'
),
train_batched AS (
  SELECT *, ((rk - 1) // 64)::BIGINT AS batch_id, ((rk - 1) % 64)::INT AS pos FROM train_ranked
)"""

PREDS = """
preds AS (
  SELECT vec_id AS example_id, (vec_id // 64)::BIGINT AS batch_id, (vec_id % 64)::INT AS pos,
         (CASE WHEN vec_id % 7 = 0 THEN -100 ELSE label END)::INT AS target_id, embedding AS logits
  FROM embeddings
),
scored AS (
  SELECT *, (list_position(logits, list_max(logits)) - 1)::INT AS pred_id,
         list_max(list_transform(logits, lambda x: x::DOUBLE)) AS m
  FROM preds
),
scored2 AS (
  SELECT example_id, batch_id, pos, target_id, logits, pred_id,
         CASE WHEN target_id <> -100 THEN (pred_id = target_id)::DOUBLE END AS correct,
         CASE WHEN target_id <> -100 THEN
           ln(list_sum(list_transform(logits, lambda x: exp(x::DOUBLE - m)))) + m - logits[target_id + 1]::DOUBLE
         END AS loss
  FROM scored
),
batches AS (
  SELECT batch_id, avg(correct) AS accuracy, avg(loss) AS loss, count(correct)::BIGINT AS valid_tokens
  FROM scored2 GROUP BY batch_id
),
epoch_batches AS (
  SELECT e.epoch, ((example_id + 17 * e.epoch) // 64)::BIGINT AS batch_id, avg(correct) AS accuracy, avg(loss) AS loss
  FROM scored2, (VALUES (0), (1)) e(epoch) GROUP BY 1, 2
),
numbered AS (
  SELECT *, batch_id // 2 AS local,
         CASE WHEN epoch = 0 THEN 0 ELSE (SELECT count(DISTINCT batch_id) // 2 FROM epoch_batches WHERE epoch = 0) END AS off
  FROM epoch_batches
),
steps AS (
  SELECT epoch::INT AS epoch, (off + local)::BIGINT AS step, sum(loss / 2) AS train_loss, sum(accuracy / 2) AS accuracy
  FROM numbered GROUP BY epoch, off + local HAVING count(*) = 2
)"""

TURNS = """
turns AS (
  SELECT u.conv_id, u.turn, u.text AS source_text, a.text AS target_text
  FROM conversations u JOIN conversations a
    ON u.conv_id = a.conv_id AND a.turn = u.turn + 1 AND u.role = 'user' AND a.role = 'assistant'
)"""

# the edge prefix of the registered queries: specials, 101 letters, a snowman, a line separator
EDGES = ("SELECT doc_id, 'x[PAD]y [EOS] [pad] [ UNK ]?[BOS] ' || repeat('a', 101) || ' ' || chr(9731) || ' a' || chr(9731) "
         "|| ' ' || chr(8232) || ' b ' || coalesce(text, '') AS text FROM documents")


def _with(body: str, select: str) -> str:
    return "WITH RECURSIVE " + body.strip().rstrip(",") + "\n" + select


def _fr_pairs_cte() -> str:
    return CORPUS_LINES + f""",
fr_words AS (SELECT unnest({plain_tok('text')}) AS word FROM corpus_lines WHERE lang = 'fr'),
fr_counts AS (SELECT word, count(*)::BIGINT AS n FROM fr_words GROUP BY word),""" + base_vocab("frbase", "fr_counts") + """,
fr_syms AS (
  SELECT word, n, i, CASE WHEN i = 1 THEN substring(word, i, 1) ELSE '##' || substring(word, i, 1) END AS sym
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM fr_counts)
),
fr_pc AS (
  SELECT a.sym AS "left", b.sym AS "right", sum(a.n)::BIGINT AS count
  FROM fr_syms a JOIN fr_syms b ON a.word = b.word AND b.i = a.i + 1
  GROUP BY a.sym, b.sym
)"""


def trainer_sql(vocab_size: int, merges: bool = False) -> str:
    """One merge a step over all word types.  A word is its symbols, each
    between two marks, so replace() merges left to right without overlap."""
    return _with(_fr_pairs_cte() + f""",
state(step, word, n, token, id) AS (
  SELECT 0, string_agg(chr(1) || sym || chr(1), '' ORDER BY i), any_value(n), NULL::VARCHAR, NULL::INT FROM fr_syms GROUP BY word
  UNION ALL
  SELECT 0, NULL, NULL, token, id FROM frbase
  UNION ALL
  (WITH v AS (SELECT token, id FROM state WHERE token IS NOT NULL),
  lists AS (SELECT n, string_split(word[2:-2], chr(1) || chr(1)) AS l FROM state WHERE token IS NULL AND contains(word, chr(1) || chr(1))),
  pc AS (SELECT a, b, sum(n) AS c FROM (SELECT n, unnest(l[1:-2]) AS a, unnest(l[2:]) AS b FROM lists) GROUP BY a, b),
  top AS (SELECT c, a, b FROM pc WHERE c = (SELECT max(c) FROM pc) AND (SELECT count(*) FROM v) < {vocab_size}),
  best AS (
    SELECT a, b, c, a || CASE WHEN starts_with(b, '##') THEN b[3:] ELSE b END AS joined
    FROM top JOIN v va ON va.token = a JOIN v vb ON vb.token = b ORDER BY va.id, vb.id LIMIT 1)
  SELECT step + 1, replace(word, chr(1) || a || chr(1) || chr(1) || b || chr(1), chr(1) || joined || chr(1)), n, NULL, NULL
  FROM state, best WHERE token IS NULL AND contains(word, chr(1) || chr(1))
  UNION ALL
  SELECT step + 1, NULL, NULL, token, id FROM state, best WHERE token IS NOT NULL
  UNION ALL
  SELECT (SELECT max(step) FROM state) + 1, NULL, NULL, joined, (SELECT count(*) FROM v)::INT
  FROM best WHERE joined NOT IN (SELECT token FROM v)
  UNION ALL
  SELECT (SELECT max(step) FROM state) + 1, a || chr(2) || b || chr(2) || joined, c, NULL, NULL FROM best)
)""", """SELECT (step - 1)::INT AS rank, string_split(word, chr(2))[1] AS "left", string_split(word, chr(2))[2] AS "right",
       string_split(word, chr(2))[3] AS joined, n::BIGINT AS count FROM state WHERE contains(word, chr(2))"""
                 if merges else "SELECT DISTINCT token, id FROM state WHERE token IS NOT NULL")


def _decode_sql(rows: str, keys: str, out: str) -> str:
    """CTEs that turn id lists (rows: keys, ids) into texts (``out``: keys, text)."""
    d = ", ".join(f"d.{k.strip()}" for k in keys.split(","))
    return f"""
{out}_t AS (SELECT {keys}, unnest(ids) AS id, unnest(range(1, len(ids) + 1)) AS k FROM {rows}),
{out}_j AS (
  SELECT {d}, d.k, v.token, row_number() OVER (PARTITION BY {d} ORDER BY d.k) AS r FROM {out}_t d JOIN vocab v ON v.id = d.id
),
{out}_p AS (
  SELECT {keys}, k,
         CASE WHEN r = 1 THEN token
              WHEN starts_with(token, '##') THEN substring(token, 3)
              ELSE regexp_replace(' ' || token, '^ ([.?!,]|n''t|''m|''s|''ve|''re)', '\\1') END AS piece
  FROM {out}_j
),
{out}_s AS (SELECT {keys}, string_agg(piece, '' ORDER BY k) AS text FROM {out}_p GROUP BY {keys}),
{out} AS (SELECT {keys}, coalesce(s.text, '') AS text FROM {rows} LEFT JOIN {out}_s s USING ({keys}))"""


ORACLE: dict[str, str] = {
    "train_wordpiece_1k": trainer_sql(1000),
    "saved_merges": trainer_sql(400, merges=True),
    "word_counts": _with(WORD_COUNTS, "SELECT lang, word, count FROM wc_lang"),
    "word_counts_incremental": _with(WORD_COUNTS, "SELECT lang, word, count FROM wc_lang"),
    "top_words": _with(WORD_COUNTS, """SELECT * FROM (
        SELECT lang, word, count, row_number() OVER (PARTITION BY lang ORDER BY count DESC, word)::INT AS rank
        FROM wc_lang) WHERE rank <= 100"""),
    "alphabet": _with(WORD_COUNTS + ",\ntotals AS (SELECT word, sum(count) AS count FROM wc_lang GROUP BY word),"
                      + base_vocab("base", "totals"), "SELECT token, id FROM base"),
    "vocab_freq": _with(VOCAB, "SELECT token, id FROM vocab"),
    "vocab_size": _with(VOCAB, "SELECT count(*)::BIGINT AS vocab_size FROM vocab"),
    "pair_counts": _with(_fr_pairs_cte(), 'SELECT "left", "right", count FROM fr_pc'),
    "best_pairs": _with(_fr_pairs_cte(), """SELECT l.id AS left_id, r.id AS right_id, p.count
        FROM fr_pc p JOIN frbase l ON l.token = p."left" JOIN frbase r ON r.token = p."right"
        ORDER BY p.count DESC, l.id, r.id LIMIT 64"""),
    "corpus_lines": _with(CORPUS_LINES, "SELECT corpus, lang, line_no, text FROM corpus_lines"),
    "pairs": _with(CORPUS_LINES, "SELECT corpus, line_no, english, french FROM pairs"),
    "turn_pairs": """SELECT u.conv_id, u.turn, u.text AS source_text, a.text AS target_text
        FROM conversations u JOIN conversations a
          ON u.conv_id = a.conv_id AND a.turn = u.turn + 1 AND u.role = 'user' AND a.role = 'assistant'""",
    "tokenize_turns": _with(VOCAB + """,
turns AS (
  SELECT u.conv_id, u.turn, u.text AS source_text, a.text AS target_text
  FROM conversations u JOIN conversations a
    ON u.conv_id = a.conv_id AND a.turn = u.turn + 1 AND u.role = 'user' AND a.role = 'assistant'
),""" + encode_rows("ts", "SELECT conv_id, turn, source_text FROM turns", "conv_id, turn",
                    src_tok("source_text"), 510) + "," +
                           encode_rows("tt", "SELECT conv_id, turn, target_text FROM turns", "conv_id, turn",
                                       tok("target_text"), None),
                           """SELECT s.conv_id, s.turn, s.ids AS src_ids, t.ids AS tgt_ids
        FROM ts s JOIN tt t USING (conv_id, turn) WHERE len(t.ids) > 5"""),
    "concat_corpora": _with(CORPUS_LINES + "," + TURNS, """SELECT corpus, english, french FROM pairs
        UNION ALL SELECT 'conversations', source_text, target_text FROM turns
        UNION ALL SELECT 'conversations', source_text, target_text FROM turns"""),
    "rename": _with(CORPUS_LINES, "SELECT corpus, line_no, text AS french FROM corpus_lines WHERE lang = 'fr'"),
    "saved_dataset": _with(CORPUS_LINES, "SELECT corpus, line_no, english, french, split FROM split_pairs"),
    "saved_vocab": _with(VOCAB, "SELECT token, id FROM vocab"),
    "token_to_id": _with(VOCAB, "SELECT t.word AS token, t.count, v.id FROM totals t LEFT JOIN vocab v ON v.token = t.word"),
    "encode_edges": _with(VOCAB + "," + encode_rows("eg", EDGES, "doc_id", tok("text"), None), "SELECT doc_id, ids FROM eg"),
    "encode_source_edges": _with(VOCAB + "," + encode_rows("eg", EDGES, "doc_id", src_tok("text"), 510), "SELECT doc_id, ids FROM eg"),
    "encode_list": _with(VOCAB + "," + encode_rows("cl", "SELECT conv_id, turn, text FROM conversations", "conv_id, turn",
                                                   tok("text"), None),
                         "SELECT conv_id, list(ids ORDER BY turn) AS ids FROM cl GROUP BY conv_id"),
    "metrics_log_eval": _with(PREDS, """SELECT 'run' AS run, 'train' AS kind, epoch, step, round(train_loss, 6) AS train_loss,
        round(accuracy, 6) AS accuracy, NULL::DOUBLE AS test_loss, NULL::DOUBLE AS test_acc FROM steps
        UNION ALL
        SELECT 'run', 'eval', s.epoch, s.step, NULL, NULL, round(e.test_loss, 6), round(e.test_acc, 6)
        FROM steps s JOIN (SELECT epoch, avg(loss) AS test_loss, avg(accuracy) AS test_acc FROM epoch_batches GROUP BY epoch) e
          ON e.epoch = s.epoch WHERE s.step % 3 = 0"""),
    "metrics_log": _with(PREDS, """SELECT epoch, step, round(train_loss, 6) AS train_loss, round(accuracy, 6) AS accuracy
        FROM steps"""),
    "train_test_split": _with(CORPUS_LINES, "SELECT corpus, line_no, split FROM split_pairs"),
    "hash_share_split": _with(CORPUS_LINES, """SELECT corpus, line_no,
        CASE WHEN ('0x' || substring(md5(concat_ws(':', '42', corpus, CAST(line_no AS VARCHAR))), 1, 12))::UBIGINT < 0.005::DOUBLE * pow(16, 12)
             THEN 'test' ELSE 'train' END AS split FROM pairs"""),
    "dataset_summary": _with(CORPUS_LINES,
                             "SELECT corpus, split, count(*)::BIGINT AS num_rows FROM split_pairs GROUP BY corpus, split"),
    "encode_target": _with(CORPUS_LINES + "," + VOCAB + "," +
                           encode_rows("tgt", "SELECT corpus, line_no, french FROM pairs", "corpus, line_no",
                                       tok("french"), None),
                           "SELECT corpus, line_no, ids AS tgt_ids FROM tgt"),
    "encode_target_truncated": _with(CORPUS_LINES + "," + VOCAB + "," +
                                     encode_rows("tt", "SELECT corpus, lang, line_no, text FROM corpus_lines",
                                                 "corpus, lang, line_no", tok("text"), 510),
                                     "SELECT corpus, lang, line_no, ids FROM tt"),
    "encode_source": _with(CORPUS_LINES + "," + VOCAB + "," +
                           encode_rows("src", "SELECT corpus, line_no, english FROM pairs", "corpus, line_no",
                                       src_tok("english"), 510),
                           "SELECT corpus, line_no, ids AS src_ids FROM src"),
    "tokenize_pairs": _with(TOKENS, "SELECT corpus, line_no, split, src_ids, tgt_ids FROM tokens"),
    "over_length_report": _with(TOKENS, """SELECT split, sum((len(src_ids) > 512)::BIGINT)::BIGINT AS src_ids_over,
        sum((len(tgt_ids) > 512)::BIGINT)::BIGINT AS tgt_ids_over, count(*)::BIGINT AS num_rows
        FROM tokens_all GROUP BY split"""),
    "decode": _with(TOKENS + """,
dec_ids AS (SELECT corpus, line_no, list_filter(tgt_ids, lambda x: x NOT IN (0, 1, 2, 3)) AS ids FROM tokens),"""
                    + _decode_sql("dec_ids", "corpus, line_no", "texts"), "SELECT corpus, line_no, text FROM texts"),
    "decode_specials": _with(TOKENS + """,
dec_ids AS (SELECT corpus, line_no, tgt_ids AS ids FROM tokens),"""
                             + _decode_sql("dec_ids", "corpus, line_no", "texts"), "SELECT corpus, line_no, text FROM texts"),
    "decode_list": _with(VOCAB + "," + encode_rows("cl", "SELECT conv_id, turn, text FROM conversations", "conv_id, turn", tok("text"), None)
                         + """,
dec_ids AS (SELECT conv_id, turn, list_filter(ids, lambda x: x NOT IN (0, 1, 2, 3)) AS ids FROM cl),"""
                         + _decode_sql("dec_ids", "conv_id, turn", "texts"),
                         "SELECT conv_id, list(text ORDER BY turn) AS texts FROM texts GROUP BY conv_id"),
    "strip_specials": _with(TOKENS, """SELECT corpus, line_no, list_filter(tgt_ids, lambda x: x NOT IN (0, 1, 2, 3)) AS ids
        FROM tokens"""),
    "assign_batches": _with(TOKENS, "SELECT corpus, line_no, batch_id, pos FROM train_batched"),
    "batch_max_len": _with(TOKENS, """SELECT batch_id, max(len(src_ids))::INT AS src_max_len,
        max(len(tgt_ids))::INT AS tgt_max_len FROM train_batched GROUP BY batch_id"""),
    "collate": _with(TOKENS + """,
mx AS (SELECT batch_id, max(len(src_ids)) AS sm, max(len(tgt_ids)) AS tm FROM train_batched GROUP BY batch_id),
padded AS (
  SELECT b.corpus, b.line_no, b.batch_id, b.pos,
         list_concat(b.src_ids, list_transform(range(mx.sm - len(b.src_ids)), lambda x: 1))::INTEGER[] AS sp,
         list_concat(b.tgt_ids, list_transform(range(mx.tm - len(b.tgt_ids)), lambda x: 1))::INTEGER[] AS tp
  FROM train_batched b JOIN mx USING (batch_id)
)""", """SELECT corpus, line_no, batch_id, pos,
        sp AS src_input_ids, list_transform(sp, lambda x: x <> 1) AS src_pad_mask,
        tp[1:len(tp) - 1] AS tgt_input_ids, list_transform(tp[1:len(tp) - 1], lambda x: x <> 1) AS tgt_pad_mask,
        list_transform(tp[2:len(tp)], lambda x: CASE WHEN x = 1 THEN -100 ELSE x END) AS tgt_outputs
        FROM padded"""),
    "collate_bucketed": _with(TOKENS + """,
mx AS (SELECT batch_id, max(len(src_ids)) AS sm, max(len(tgt_ids)) AS tm FROM train_batched GROUP BY batch_id),
padded AS (
  SELECT b.corpus, b.line_no, b.batch_id, b.pos,
         list_concat(b.src_ids, list_transform(range(mx.sm - len(b.src_ids)), lambda x: 1))::INTEGER[] AS sp,
         list_concat(b.tgt_ids, list_transform(range(mx.tm - len(b.tgt_ids)), lambda x: 1))::INTEGER[] AS tp
  FROM train_batched b JOIN mx USING (batch_id)
)""", """SELECT corpus, line_no, batch_id, pos,
        sp AS src_input_ids, list_transform(sp, lambda x: x <> 1) AS src_pad_mask,
        tp[1:len(tp) - 1] AS tgt_input_ids, list_transform(tp[1:len(tp) - 1], lambda x: x <> 1) AS tgt_pad_mask,
        list_transform(tp[2:len(tp)], lambda x: CASE WHEN x = 1 THEN -100 ELSE x END) AS tgt_outputs
        FROM padded"""),
    "epoch_order": _with(TOKENS, """SELECT corpus, line_no, (rk - 1)::BIGINT AS rank, batch_id, pos FROM train_batched"""),
    "epoch_batches": _with(TOKENS, """SELECT batch_id, pos, corpus, line_no, src_ids, tgt_ids FROM train_batched
        WHERE batch_id IN (0, 7, 15)"""),
    "collate_eval": _with(TOKENS + """,
test_ranked AS (
  SELECT *, row_number() OVER (ORDER BY corpus, line_no) AS rk FROM tokens WHERE split = 'test'
),
test_batched AS (SELECT *, ((rk - 1) // 64)::BIGINT AS batch_id, ((rk - 1) % 64)::INT AS pos FROM test_ranked),
mx AS (SELECT batch_id, max(len(src_ids)) AS sm, max(len(tgt_ids)) AS tm FROM test_batched GROUP BY batch_id),
padded AS (
  SELECT b.corpus, b.line_no, b.batch_id, b.pos,
         list_concat(b.src_ids, list_transform(range(mx.sm - len(b.src_ids)), lambda x: 1))::INTEGER[] AS sp,
         list_concat(b.tgt_ids, list_transform(range(mx.tm - len(b.tgt_ids)), lambda x: 1))::INTEGER[] AS tp
  FROM test_batched b JOIN mx USING (batch_id)
)""", """SELECT corpus, line_no, batch_id, pos,
        sp AS src_input_ids, list_transform(sp, lambda x: x <> 1) AS src_pad_mask,
        tp[1:len(tp) - 1] AS tgt_input_ids, list_transform(tp[1:len(tp) - 1], lambda x: x <> 1) AS tgt_pad_mask,
        list_transform(tp[2:len(tp)], lambda x: CASE WHEN x = 1 THEN -100 ELSE x END) AS tgt_outputs
        FROM padded"""),
    "predictions": _with(PREDS, """SELECT example_id, batch_id, pos, target_id, pred_id, correct, round(loss, 6) AS loss
        FROM scored2"""),
    "predictions_sharded": _with(PREDS, """SELECT example_id, batch_id, pos, target_id, pred_id, correct, round(loss, 6) AS loss
        FROM scored2"""),
    "valid_positions": _with(PREDS, "SELECT example_id, batch_id, pos, target_id FROM preds WHERE target_id <> -100"),
    "batch_metrics": _with(PREDS, """SELECT batch_id, round(accuracy, 6) AS accuracy, round(loss, 6) AS loss, valid_tokens
        FROM batches"""),
    "eval_mean": _with(PREDS, """SELECT round(avg(loss), 6) AS test_loss, round(avg(accuracy), 6) AS test_acc,
        round(sum(loss * valid_tokens) / sum(valid_tokens), 6) AS weighted_loss,
        round(sum(accuracy * valid_tokens) / sum(valid_tokens), 6) AS weighted_acc FROM batches"""),
    "rank_mean": _with(PREDS, """SELECT (batch_id // 2)::BIGINT AS local_batch, round(avg(loss), 6) AS loss,
        round(avg(accuracy), 6) AS accuracy FROM batches GROUP BY batch_id // 2"""),
    "step_metrics": _with(PREDS, """SELECT epoch, step, round(train_loss, 6) AS train_loss, round(accuracy, 6) AS accuracy
        FROM steps"""),
    "eval_points": _with(PREDS, """SELECT epoch, step, round(train_loss, 6) AS train_loss, round(accuracy, 6) AS accuracy
        FROM steps WHERE step % 3 = 0"""),
    "clip_generated": _with(PREDS, """SELECT batch_id,
        ids[1:least(512, CASE WHEN coalesce(list_position(ids, 3), 0) = 0 THEN 512 ELSE list_position(ids, 3) END)] AS ids
        FROM (SELECT batch_id, list(pred_id ORDER BY pos) AS ids FROM scored GROUP BY batch_id)"""),
    "flagship": _with(TOKENS, """SELECT split, count(*)::BIGINT AS num_rows, round(avg(len(src_ids)), 6) AS mean_src_len,
        round(avg(len(tgt_ids)), 6) AS mean_tgt_len, max(len(src_ids))::INT AS max_src_len,
        max(len(tgt_ids))::INT AS max_tgt_len FROM tokens GROUP BY split"""),
}
