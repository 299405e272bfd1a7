"""DuckDB SQL for the queries that SQL can express."""

MIXING = r"""
WITH measured AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5(coalesce(text, '')) AS of_text FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM measured GROUP BY source
), placed AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sources
), weighed AS (
  SELECT *, CASE place % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, source_size * 2.0::DOUBLE AS cap FROM placed
), ordered AS (
  SELECT *, cap / weight AS full_at, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS wanted FROM weighed
), levelled AS (
  SELECT *, (wanted - coalesce(sum(cap) OVER (ORDER BY full_at, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY full_at, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM ordered
), chosen AS (
  SELECT level FROM levelled WHERE level <= full_at ORDER BY full_at, place LIMIT 1
), targets AS (
  SELECT source, source_size, least(cap, coalesce((SELECT level FROM chosen) * weight, cap)) AS target FROM ordered
), rated AS (
  SELECT m.doc_id, m.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
    ('0x' || substr(md5('mix-1:' || coalesce(m.doc_id::VARCHAR, '') || ':' || m.of_text), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE AS draw
  FROM measured m JOIN targets t ON m.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM rated
"""


def licenses() -> str:
    """Exact containment of every window, without MinHash."""
    from .licenses import TEMPLATES, plan_of

    rows = ", ".join("('%s', '%s')" % (name, text.replace("'", "''")) for name, text in sorted(TEMPLATES.items()))
    plans = ", ".join("(%d, %d, %d)" % (length, *plan_of(length)[:2]) for length in range(5, 64))
    cut = (
        "[w for w in string_split_regex(translate(%s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
        r"'[\x00-/:-`{-\x7f]+') if w <> '']"
    )
    shingle = "words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] || ' ' || words[i + 3] || ' ' || words[i + 4]"
    return f"""
WITH templates(license_id, body) AS (VALUES {rows}), plans(length, stride, span) AS (VALUES {plans}),
known AS (SELECT license_id, {cut % "body"} AS words FROM templates),
wanted AS (SELECT DISTINCT license_id, len(words) AS length, {shingle} AS shingle FROM known, unnest(range(1, len(words) - 3)) AS r(i)),
counted AS (SELECT license_id, length, count(*) AS n FROM wanted GROUP BY ALL),
docs AS (SELECT doc_id, {cut % "text"} AS words FROM documents),
held AS (SELECT doc_id, len(words) AS n_words, i - 1 AS pos, {shingle} AS shingle FROM docs, unnest(range(1, len(words) - 3)) AS r(i)),
hits AS (SELECT h.doc_id, h.n_words, h.pos, w.license_id, w.length, h.shingle, p.stride, p.span
  FROM held h JOIN wanted w ON h.shingle = w.shingle JOIN plans p ON p.length = w.length),
placed AS (SELECT doc_id, license_id, length, shingle, k * stride AS start FROM hits,
  unnest(range(CAST(greatest(0, floor((pos + 5 - span + stride - 1) / stride)) AS BIGINT), CAST(floor(pos / stride) AS BIGINT) + 1)) AS r(k)
  WHERE k * stride <= greatest(n_words - length, 0) AND k * stride <= pos AND pos + 5 <= k * stride + span),
shares AS (SELECT p.doc_id, p.license_id, p.start, count(DISTINCT p.shingle)::DOUBLE / any_value(c.n) AS containment
  FROM placed p JOIN counted c ON c.license_id = p.license_id GROUP BY p.doc_id, p.license_id, p.start)
SELECT doc_id, license_id, max(containment) AS containment, count(*)::BIGINT AS n_windows FROM shares WHERE containment >= 0.8
GROUP BY doc_id, license_id
"""
