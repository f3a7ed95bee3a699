"""SQL for training-data queries that needs more than a few lines."""

from __future__ import annotations

_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _LOW.format("coalesce(text, '')") + ", '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

#: CRC-32 is folded over the bytes of each distinct word, with its usual table of 256 remainders.
RESAMPLING_SQL = f"""WITH steps AS (SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS remainders
      FROM range(256) t(b)),
    docs AS (SELECT row_number() OVER () AS k, doc_id, {_WORDS} AS w FROM documents),
    doc_words AS (SELECT k, unnest(w) AS word FROM docs),
    bench_words AS (SELECT unnest({_WORDS}) AS word FROM benchmark),
    hashed AS (SELECT word, xor(list_reduce(list_transform(range(1, 2 * octet_length(encode(word)) + 1, 2), lambda i: ('0x' || substring(hex(encode(word)), i, 2))::BIGINT),
        lambda c, b: xor(c >> 8, remainders[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 10000 AS bucket
      FROM (SELECT DISTINCT word FROM (FROM doc_words SELECT word UNION ALL FROM bench_words)), steps),
    own AS (SELECT bucket, count(*) AS s FROM doc_words JOIN hashed USING (word) GROUP BY bucket),
    aim AS (SELECT bucket, count(*) AS t FROM bench_words JOIN hashed USING (word) GROUP BY bucket),
    gains AS (SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM doc_words) + 10000)) /
        ((s + 1)::DOUBLE * ((SELECT count(*) FROM bench_words) + 10000))))::BIGINT AS gain FROM own LEFT JOIN aim USING (bucket)),
    weights AS (SELECT k, sum(gain)::BIGINT AS weight FROM doc_words JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY k),
    scored AS (SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
        coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substring(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
      FROM docs LEFT JOIN weights USING (k)),
    placed AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_features >= 20) AS n FROM scored)
    SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= n // 10 THEN place END AS rank FROM placed"""


def vector_codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> str:
    """The rounds unrolled: one pair of tables, nearest entries and new books, for each."""
    def assigned(name: str, book: str) -> str:
        return f"""{name} AS MATERIALIZED (SELECT r, part, min(d * {entries} + entry) AS best FROM
            (SELECT r, part, entry, sum((x - c) * (x - c)) AS d FROM cells JOIN {book} USING (part, i) GROUP BY r, part, entry) GROUP BY r, part)"""

    tables = [
        f"""kept AS (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, list_transform(embedding, lambda e: floor({scale} * e::DOUBLE)::BIGINT) AS v
            FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0)""",
        f"""cells AS MATERIALIZED (SELECT r, (k - 1) // (n // {parts}) AS part, (k - 1) % (n // {parts}) AS i, x
            FROM (SELECT r, len(v) AS n, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS k FROM kept))""",
        f"b0 AS MATERIALIZED (SELECT part, i, r - 1 AS entry, x AS c FROM cells WHERE r <= {entries})",
    ]
    for k in range(rounds):
        tables.append(assigned(f"a{k}", f"b{k}"))
        tables.append(
            f"""b{k + 1} AS MATERIALIZED (SELECT part, i, entry, coalesce(m, c) AS c FROM b{k} LEFT JOIN
            (SELECT part, i, best % {entries} AS entry, floor(sum(x)::DOUBLE / count(*))::BIGINT AS m FROM cells JOIN a{k} USING (r, part) GROUP BY ALL) USING (part, i, entry))"""
        )
    tables.append(assigned("last", f"b{rounds}"))
    tables.append(
        f"""coded AS (SELECT r, string_agg(printf('%02x', (best % {entries})::INT), '' ORDER BY part) AS code, sum(best // {entries})::BIGINT AS error FROM last GROUP BY r)"""
    )
    return (
        "WITH " + ", ".join(tables)
        + f""" SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
            (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, i)) FROM b{rounds}) AS codebooks_sha256 FROM coded JOIN kept USING (r)"""
    )


#: Every window of 35 words is grouped; words between white space hold no space, so joined windows are unambiguous.
PASSAGES_SQL = r"""WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    windows AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM docs WHERE len(w) >= 35)),
    hit AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS k FROM windows WHERE s IN (SELECT s FROM windows GROUP BY s HAVING count(*) > 1)),
    words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM docs),
    kept AS (SELECT doc_id, count(hit.k) AS n, string_agg(word, ' ' ORDER BY words.k) FILTER (WHERE hit.k IS NULL) AS t
      FROM words LEFT JOIN hit USING (doc_id, k) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM docs LEFT JOIN kept USING (doc_id)"""

#: Every 100-byte string is grouped, as hexadecimal digits; all but its earliest place remove their bytes.
STRINGS_SQL = """WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    windows AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS s FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS i FROM docs WHERE length(h) >= 200)),
    late AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1),
    marked AS (SELECT doc_id, i, i + 100 AS stop, max(i + 100) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM late),
    numbered AS (SELECT *, count(*) FILTER (WHERE reach IS NULL OR i > reach) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked),
    spans AS (SELECT doc_id, span, min(i) AS a, max(stop) AS b FROM numbered GROUP BY doc_id, span),
    own AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, list(a ORDER BY a) AS starts, list(b ORDER BY a) AS stops FROM spans GROUP BY doc_id)
    SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
      sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE array_to_string(list_transform(range(0, n_spans + 1), lambda k:
        substr(h, 2 * CASE WHEN k = 0 THEN 0 ELSE stops[k] END + 1, 2 * (CASE WHEN k = n_spans THEN length(h) // 2 ELSE starts[k + 1] END - CASE WHEN k = 0 THEN 0 ELSE stops[k] END))), '') END)) AS kept_sha256
    FROM docs LEFT JOIN own USING (doc_id)"""
