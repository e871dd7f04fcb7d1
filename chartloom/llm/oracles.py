"""The numbered operators in SQL, where SQL can express them. Fixed values are written out again."""

from __future__ import annotations

_WORDS = r"""
given AS (SELECT row_number() OVER () AS rid, * REPLACE (coalesce(text, '') AS text) FROM documents),
split AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM given)"""

QUALITY = rf"""
WITH {_WORDS},
lines AS (
  SELECT rid, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM given),
windows AS (
  SELECT rid, i, array_to_string(words[i:i + 4], ' ') AS w
  FROM (SELECT rid, words, unnest(range(1, len(words) - 3)) AS i FROM split WHERE len(words) >= 5)),
repeated AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, w) > 1),
covered AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM repeated, (SELECT unnest(range(5)) AS k) GROUP BY rid),
counted AS (
  SELECT split.rid, doc_id, lang, source, len(words) AS n_words,
         coalesce(CAST(list_sum(list_transform(words, lambda x: length(x))) AS BIGINT), 0) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words
  FROM split JOIN lines ON lines.rid = split.rid LEFT JOIN covered ON covered.rid = split.rid),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted),
measured AS (
  SELECT rid, lang, source, base_failed, unnest(['symbol_rate', 'dup_line_rate', 'word_length']) AS m,
         unnest([15, 20, 60]) AS least,
         unnest([1000 * n_symbols // greatest(word_chars, 1), 1000 * n_dup_lines // greatest(n_words, 1),
                 100 * word_chars // greatest(n_words, 1)]) AS v
  FROM judged),
bucketed AS (
  SELECT *, v - v % (CAST(1 AS BIGINT) << CAST(greatest(length(bin(v)) - 6, 0) AS BIGINT)) AS b
  FROM measured WHERE NOT base_failed),
levels AS (
  SELECT 0 AS level, m, lang, source, b FROM bucketed
  UNION ALL SELECT 1, m, lang, NULL, b FROM bucketed
  UNION ALL SELECT 2, m, NULL, NULL, b FROM bucketed),
ends AS (
  SELECT level, m, lang, source, count(*) AS size,
         list_sort(list(b))[(count(*) + 3) // 4] AS q1, list_sort(list(b))[(3 * count(*) + 3) // 4] AS q3
  FROM levels GROUP BY ALL),
inside AS (
  SELECT x.rid, x.m, arg_min(
           x.v BETWEEN e.q1 - 3 * greatest(e.q3 - e.q1, x.least) AND e.q3 + 3 * greatest(e.q3 - e.q1, x.least),
           e.level) AS ok
  FROM measured x JOIN ends e ON e.m = x.m AND (e.level = 2 OR e.size >= 200)
       AND (e.level = 2 OR e.lang IS NOT DISTINCT FROM x.lang)
       AND (e.level > 0 OR e.source IS NOT DISTINCT FROM x.source)
  WHERE NOT x.base_failed GROUP BY x.rid, x.m),
verdict AS (SELECT rid, bool_and(ok) AS ok FROM inside GROUP BY rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(ok, false) AS kept
FROM judged LEFT JOIN verdict ON verdict.rid = judged.rid"""

REPEATS = rf"""
WITH {_WORDS},
windows AS (
  SELECT rid, doc_id, i, array_to_string(words[i:i + 49], ' ') AS w
  FROM (SELECT rid, doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM split WHERE len(words) >= 50)),
late AS (SELECT rid, i FROM windows QUALIFY min(doc_id) OVER (PARTITION BY w) < doc_id),
gone AS (
  SELECT rid, list(DISTINCT i + k) AS places FROM late, (SELECT unnest(range(50)) AS k) GROUP BY rid)
SELECT doc_id, len(words) AS n_words, coalesce(len(places), 0) AS n_removed,
       sha256(array_to_string(CASE WHEN places IS NULL THEN words ELSE
              list_filter(words, lambda x, i: NOT list_contains(places, i)) END, ' ')) AS kept_sha256
FROM split LEFT JOIN gone ON gone.rid = split.rid"""

CHAT = r"""
WITH given AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
turns AS (SELECT *, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS lone FROM given),
sized AS (
  SELECT *, length(concat('<|turn_start|>', role, chr(10), regexp_replace(text,
      '(<|\[)(\\*(?:\|turn_start\|>|\|turn_end\|>|\|endoftext\|>|\|startoftext\|>|\|im_start\|>|\|im_end\|>|s>|/s>|unk>|INST\]|/INST\]|<SYS>>|</SYS>>))',
      '\1\\\2', 'g'), '<|turn_end|>', chr(10))) AS n,
    row_number() OVER (PARTITION BY conv_id, lone ORDER BY turn DESC) AS from_end
  FROM turns),
running AS (
  SELECT *, sum(n) OVER (PARTITION BY conv_id, lone ORDER BY turn) AS so_far,
         role = 'assistant' OR from_end = 1 AS ends_example FROM sized)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(so_far) FILTER (ends_example) AS BIGINT) AS formatted_chars,
       count(*) FILTER (ends_example) AS n_examples
FROM running GROUP BY conv_id, lone"""

SEARCH = r"""
WITH given AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
occurring AS (
  SELECT rid, doc_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM given),
counted AS (SELECT rid, doc_id, term, count(*) AS tf FROM occurring GROUP BY ALL),
lengths AS (SELECT rid, count(*) AS n FROM occurring GROUP BY rid),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counted, totals GROUP BY term),
items AS (SELECT row_number() OVER () AS item, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark)),
asked AS (
  SELECT DISTINCT item, item_id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM items),
scored AS (
  SELECT item, item_id, c.rid, c.doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) AS BIGINT) AS score
  FROM asked a JOIN counted c ON c.term = a.term JOIN weights ON weights.term = c.term
       JOIN lengths ON lengths.rid = c.rid, totals
  GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10"""

JACCARD = r"""
WITH RECURSIVE given AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT rid, doc_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS words
  FROM given),
shingles AS (
  SELECT DISTINCT rid, array_to_string(words[i:i + 2], ' ') AS s
  FROM (SELECT rid, words, unnest(range(1, greatest(len(words) - 1, 2))) AS i FROM split WHERE len(words) > 0)),
sizes AS (SELECT rid, count(*) AS n FROM shingles GROUP BY rid),
pairs AS (
  SELECT a.rid AS x, b.rid AS y, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.rid < b.rid GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs JOIN sizes p ON p.rid = x JOIN sizes q ON q.rid = y
  WHERE 100 * shared >= 90 * (p.n + q.n - shared)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached AS (
  SELECT rid AS origin, rid AS place FROM split
  UNION SELECT origin, y FROM reached JOIN ways ON x = place),
least AS (
  SELECT origin, min(doc_id) AS component_id FROM reached JOIN split ON rid = place GROUP BY origin)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM split LEFT JOIN sizes ON sizes.rid = split.rid JOIN least ON origin = split.rid"""

SQL = {
    "op2_quality_rules": QUALITY,
    "op7_super_kmers": REPEATS,
    "op9_prefix_targets": CHAT,
    "op11_bit_sliced_search": SEARCH,
    "op12_token_combinations": JACCARD,
}
