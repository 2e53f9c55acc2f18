"""SQL for the corpus queries that SQL can express, written from their definitions."""

from __future__ import annotations

WARC = """
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS digest, CAST(strlen(coalesce(html, '')) AS BIGINT) AS bytes
           FROM pages),
     g AS (SELECT digest AS d, max(page_id) AS response FROM p WHERE bytes >= 1000 GROUP BY digest)
SELECT page_id, bytes AS payload_bytes, digest AS payload_digest,
       CASE WHEN response IS NULL OR response IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN response IS DISTINCT FROM page_id THEN response END AS refers_to
FROM p LEFT JOIN g ON d = digest"""

# Every quotient of every source is listed, and then of every shard; the highest ones are seats.
MIX = r"""
WITH sized AS (
       SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
              md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS digest FROM documents),
     ordered AS (
       SELECT source, sum(size)::BIGINT AS total, row_number() OVER (ORDER BY source NULLS LAST) AS nth
       FROM sized GROUP BY source),
     weighed AS (
       SELECT *, CASE (nth - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, (SELECT sum(size) FROM sized) AS house
       FROM ordered),
     -- Sources in the order in which a rising level fills them up to three times their size.
     filling AS (
       SELECT *, CAST(house - coalesce(sum(3 * total) OVER before, 0) AS DOUBLE) AS rest,
              CAST(sum(weight) OVER upto AS DOUBLE) AS weights
       FROM weighed
       WINDOW before AS (ORDER BY 3e0 * total / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
              upto AS (ORDER BY 3e0 * total / weight, nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
     level AS (SELECT rest, weights FROM filling WHERE rest * weight / weights <= 3 * total
               ORDER BY 3e0 * total / weight, nth LIMIT 1),
     goals AS (
       SELECT source, nth, total, house, least(3e0 * total, level.rest * weight / level.weights) AS target,
              CAST(greatest(1, least(4096, ceil(total / 2e6))) AS BIGINT) AS shards
       FROM weighed, level),
     placed AS (
       SELECT s.*, g.total, g.target, ('0x' || substr(digest, 1, 3))::BIGINT % shards AS shard
       FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source),
     shard_sizes AS (
       SELECT source, shard, sum(size)::BIGINT AS words, CAST(ceil(sum(size) / 16e0) AS BIGINT) AS blocks
       FROM placed GROUP BY source, shard),
     limits AS (SELECT source, sum(3 * blocks)::BIGINT AS most FROM shard_sizes GROUP BY source),
     quotients AS (
       SELECT g.source, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, nth, k) AS place, house
       FROM goals g JOIN limits l ON l.source IS NOT DISTINCT FROM g.source,
            LATERAL (SELECT unnest(range(0, most)) AS k) WHERE target > 0),
     seats AS (SELECT source, count(*) AS n FROM quotients WHERE place <= round_even(house / 16e0, 0) GROUP BY source),
     shard_quotients AS (
       SELECT h.source, shard, n, row_number() OVER (PARTITION BY h.source ORDER BY words / (2e0 * k + 1) DESC, shard, k) AS place
       FROM shard_sizes h JOIN seats s ON s.source IS NOT DISTINCT FROM h.source,
            LATERAL (SELECT unnest(range(0, 3 * blocks)) AS k) WHERE words > 0),
     quotas AS (
       SELECT h.source, h.shard, greatest(h.blocks, 1) AS blocks, coalesce(q.quota, 0) AS quota,
              ('0x' || substr(md5('mix:' || coalesce(h.source, 'None') || ':' || h.shard), 1, 15))::BIGINT % greatest(h.blocks, 1) AS start
       FROM shard_sizes h LEFT JOIN (
         SELECT source, shard, count(*) AS quota FROM shard_quotients WHERE place <= n GROUP BY source, shard) q
       ON q.source IS NOT DISTINCT FROM h.source AND q.shard = h.shard),
     laid AS (
       SELECT p.*, blocks, quota // blocks AS copies, quota % blocks AS extra, start,
              least(quota % blocks, blocks - start) AS straight,
              sum(size) OVER (PARTITION BY p.source, p.shard ORDER BY digest, doc_id, size ROWS UNBOUNDED PRECEDING) AS high
       FROM placed p JOIN quotas q ON q.source IS NOT DISTINCT FROM p.source AND q.shard = p.shard)
SELECT doc_id, size, total AS source_size, target,
       CAST(copies * size
            + greatest(0, least(high, 16 * (extra - straight)) - greatest(high - size, 0))
            + greatest(0, least(high, 16 * (start + straight)) - greatest(high - size, 16 * start)) AS BIGINT) AS taken
FROM laid"""

TOP = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
           FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM s QUALIFY rank <= 5"""

LEAKS = r"""
WITH d AS (SELECT row_number() OVER () AS nth, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
     b AS (SELECT item_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
     windows AS (
       SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS pattern
       FROM (SELECT *, least(10, len(w)) AS m FROM b WHERE len(w) > 0), LATERAL (SELECT unnest(range(1, len(w) - m + 2)) AS i)),
     places AS (
       SELECT nth, i, m, array_to_string(w[i:i + m - 1], ' ') AS pattern
       FROM d, (SELECT DISTINCT m FROM windows), LATERAL (SELECT unnest(range(1, len(w) - m + 2)) AS i)),
     hits AS (SELECT nth, i, p.m AS m, item_id FROM places p JOIN windows USING (pattern)),
     words AS (SELECT nth, count(DISTINCT i + k) AS n FROM hits, LATERAL (SELECT unnest(range(0, m)) AS k) GROUP BY nth),
     items AS (SELECT nth, count(*) AS n, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
               FROM (SELECT DISTINCT nth, item_id FROM hits) GROUP BY nth)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, words.n IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (nth) LEFT JOIN items USING (nth)"""

# CRC-32 of the decimal form of a number, bit by bit.
CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(8 * len({0}::VARCHAR)),
        lambda i: CASE WHEN i % 8 = 0 THEN ascii(({0}::VARCHAR)[i // 8 + 1])::BIGINT ELSE 0 END)),
        lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))))"""

TRIE = rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           WHERE conv_id IS NOT NULL),
     u AS (SELECT conv_id, turn, role, sha256(strlen(role) || ':' || role || text) AS unit,
                  len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM t),
     own AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, unit[:32], words) AS nth FROM u),
     ids AS (SELECT conv_id, conv_id - conv_id % 20 AS head, {CRC.format("conv_id")} % 4 AS h
             FROM (SELECT DISTINCT conv_id FROM t)),
     turns AS (
       SELECT i.conv_id, 0 AS part, nth, unit, words FROM ids i JOIN own o ON o.conv_id = i.head AND nth <= h
       UNION ALL
       SELECT i.conv_id, 1 AS part, nth, unit, words FROM ids i JOIN own o ON o.conv_id = i.conv_id AND nth > h),
     paths AS (SELECT i.conv_id, coalesce(list(unit ORDER BY part, nth) FILTER (unit IS NOT NULL), []) AS path,
                      coalesce(list(words ORDER BY part, nth) FILTER (unit IS NOT NULL), []) AS words
               FROM ids i LEFT JOIN turns t ON t.conv_id = i.conv_id GROUP BY i.conv_id),
     nodes AS (
       SELECT d, array_to_string(path[1:d], ',') AS prefix, any_value(path[1:d]) AS path, min(conv_id) AS conv_id, count(*) AS n,
              any_value(CASE WHEN d > 0 THEN words[d] ELSE 0 END) AS words,
              coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(path) = d), '') AS ends
       FROM paths, LATERAL (SELECT unnest(range(0, len(path) + 1)) AS d) GROUP BY d, prefix),
     kids AS (SELECT array_to_string(path[1:d - 1], ',') AS prefix, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
     whole AS (SELECT n.*, coalesce(k.n, 0) AS children FROM nodes n LEFT JOIN kids k ON k.prefix = n.prefix AND k.d = n.d),
     sums AS (SELECT array_to_string(path[1:a], ',') AS prefix, a AS d, sum(CASE WHEN children = 0 THEN 1 ELSE 0 END) AS leaves,
                     sum((n - 1) * words) AS saved
              FROM whole, LATERAL (SELECT unnest(range(0, d + 1)) AS a) GROUP BY ALL)
SELECT w.conv_id, w.d::BIGINT AS depth, p.conv_id AS parent_conv_id, w.n::BIGINT AS n_convs, w.children::BIGINT AS n_children,
       s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(w.ends) AS ends_sha256
FROM whole w JOIN sums s ON s.prefix = w.prefix AND s.d = w.d
LEFT JOIN whole p ON p.d = w.d - 1 AND p.prefix = array_to_string(w.path[1:w.d - 1], ',')"""

# Levels of all language trees, then of the tree of their roots; a fold is one step a level.
MERKLE = rf"""
WITH RECURSIVE d AS (
       SELECT row_number() OVER () AS nth, doc_id, lang,
              concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                     coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
              text, CASE WHEN {CRC.format("doc_id")} % 3 = 0
                         THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS other
       FROM documents),
     hashed AS (SELECT nth, doc_id, coalesce('=' || lang, '-') AS tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                       sha256(head || coalesce(strlen(other) || ':' || other, '-')) AS offered FROM d),
     leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                       count(*) OVER (PARTITION BY tree) AS n FROM hashed),
     low AS (
       SELECT tree, 0 AS level, pos, leaf AS h, n FROM leaves
       UNION ALL
       SELECT tree, level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (n + 7) // 8 FROM low WHERE n > 1
       GROUP BY tree, level, pos // 8, n),
     subroots AS (SELECT tree, level AS height, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n
                  FROM low WHERE n = 1),
     high AS (
       SELECT 0 AS level, pos, subroot AS h, n FROM subroots
       UNION ALL
       SELECT level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (n + 7) // 8 FROM high WHERE n > 1
       GROUP BY level, pos // 8, n),
     low_run AS (SELECT tree, level, pos, n, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                        coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
                 FROM low WINDOW w AS (PARTITION BY tree, level, pos // 8 ORDER BY pos)),
     high_run AS (SELECT level, pos, n, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                         coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
                  FROM high WINDOW w AS (PARTITION BY level, pos // 8 ORDER BY pos)),
     up AS (
       SELECT nth, tree, 0 AS level, pos, offered AS h, '' AS proof FROM leaves
       UNION ALL
       SELECT nth, u.tree, u.level + 1, u.pos // 8, sha256(l || h || r), proof || l || r
       FROM up u JOIN low_run s ON s.tree = u.tree AND s.level = u.level AND s.pos = u.pos WHERE n > 1),
     on_top AS (
       SELECT nth, 0 AS level, s.pos, h, proof FROM up u JOIN subroots s ON s.tree = u.tree AND s.height = u.level
       UNION ALL
       SELECT nth, u.level + 1, u.pos // 8, sha256(l || h || r), proof || l || r
       FROM on_top u JOIN high_run s ON s.level = u.level AND s.pos = u.pos WHERE n > 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, o.h AS folded_root, o.h = root AS verified
FROM leaves x JOIN subroots s ON s.tree = x.tree JOIN (SELECT level, h AS root FROM high WHERE n = 1) top ON true
JOIN on_top o ON o.nth = x.nth AND o.level = top.level"""

ORACLES: dict[str, str] = {"op3_warc": WARC, "op6_mix": MIX, "op10_topk": TOP, "op11_decontaminate": LEAKS, "op12_trie": TRIE, "op13_merkle": MERKLE}
