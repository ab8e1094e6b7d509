"""DuckDB statements that give the same rows as the registered queries."""

from __future__ import annotations

_SQL: dict[str, str] = {}


def all_sql() -> dict[str, str]:
    return dict(_SQL)


def _with(*ctes: str) -> str:
    """WITH clause of the named common tables and everything they use, in order."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, ()):
            add(need)
        if name not in wanted:
            wanted.append(name)

    for name in ctes:
        add(name)
    return "WITH RECURSIVE " + ",\n".join(
        f"{n} AS {'MATERIALIZED ' if n in _KEPT else ''}({_CTE[n]})" for n in wanted
    ) + "\n"


_SUPER = "array_to_string(list_slice(string_split({0}, '.'), -2, -1), '.')"
_HREFS = """regexp_extract_all(html, '<a\\s+href="([^"]*)"', 1)"""
_HOST = "lower(regexp_extract({0}, '//([^/?#]*)', 1))"
_FAIL = "status IN (429, 417, 403, 401, 500, 0)"
_EXT = """regexp_matches(lower(regexp_extract({0}, '//[^/?#]*([^?#]*)', 1)),
    '\\.(jpg|jpeg|png|gif|bmp|svg|webp|ico|pdf|ps|eps|mp3|wav|ogg|flac|mp4|mkv|avi|mov|wmv|webm|css|js|mjs|ts|zip|tar|gz|tgz|rar|7z|apk|dmg|exe|bin|iso|rss|json|txt|csv)$')"""
_NODE = "'https://h' || ({0} % 17) || '.example.com/p/' || ({0})"

_CTE = {
    "n": "SELECT count(*) AS n FROM pages",
    "clean": """SELECT page_id, regexp_replace(url, '#.*$', '') AS url, url AS base, html FROM pages""",
    "facts": f"""SELECT page_id, url, {_HOST.format("url")} AS domain,
        {_SUPER.format(_HOST.format("url"))} AS superdomain,
        CAST(strlen(html) AS BIGINT) AS size,
        CAST(len(list_distinct({_HREFS})) AS BIGINT) AS n_links FROM clean""",
    "log0": """SELECT 'run' || (user_id % 3) AS log, event_id AS seq, e.ts, f.url,
        CASE WHEN event_type = 'signup' AND event_id % 4 = 0 THEN 404
             WHEN event_type = 'error' THEN [429, 417, 403, 401, 500, 0][event_id % 6 + 1]
             ELSE 200 END AS status,
        CAST(user_id % 5 AS INTEGER) AS depth,
        (user_id % 5) - (event_id % 7) * CAST(0.000125 AS DOUBLE) AS priority,
        f.domain, f.superdomain, f.size, f.n_links,
        CAST(100 + floor(value * 10) AS BIGINT) AS elapsed_ms,
        event_id % 10 <> 0 AS debug_ok
        FROM events e JOIN facts f ON f.page_id = e.event_id % (SELECT n FROM n)""",
    "log1": """SELECT *, CASE WHEN status = 200 THEN size ELSE 0 END AS bytes,
        CASE WHEN status = 200 THEN n_links ELSE 0 END AS found FROM log0""",
    "log": """SELECT log, seq, ts, url, status, bytes, depth, priority, domain, superdomain, elapsed_ms,
        debug_ok,
        CASE WHEN debug_ok THEN 'text/html' END AS ct,
        CASE WHEN debug_ok THEN elapsed_ms * 7 // 10 END AS t_connect_ms,
        CASE WHEN debug_ok THEN elapsed_ms * 2 // 10 END AS t_read_ms,
        CASE WHEN debug_ok THEN seq % 50 END AS t_parse_ms,
        CASE WHEN debug_ok THEN found END AS links_found,
        CASE WHEN debug_ok THEN greatest(0, found - seq % 3) END AS links_enqueued,
        CASE WHEN debug_ok THEN CAST(bytes >= 4096 AS INTEGER) END AS html_truncated
        FROM log1""",
    "ruled": """SELECT *, CASE WHEN seq % 97 = 0 THEN 97 WHEN seq % 101 = 0 THEN 101
        WHEN seq % 103 = 0 THEN 103 WHEN seq % 107 = 0 THEN 107 WHEN seq % 109 = 0 THEN 109
        WHEN seq % 113 = 0 THEN 113 ELSE 0 END AS rule FROM log""",
    "ends": "SELECT log, count(*) AS n, max(seq) AS last FROM log GROUP BY log",
    "raw": """SELECT log, seq AS ord,
          strftime(ts, '%Y-%m-%d %H:%M:%S') || chr(9) || url || chr(9)
          || CASE WHEN rule = 103 THEN 'abc' ELSE status::VARCHAR END || chr(9)
          || CASE WHEN rule = 97 THEN 'n/a' WHEN rule = 107 THEN '-5' ELSE bytes::VARCHAR END || chr(9)
          || depth || chr(9) || printf('%.6f', priority) || chr(9) || domain || chr(9) || seq
          || chr(9) || superdomain
          || CASE WHEN rule = 101 THEN '' ELSE chr(9) || seq || chr(9) || elapsed_ms
             || CASE WHEN debug_ok THEN chr(9) || ct || chr(9) || t_connect_ms || chr(9) || t_read_ms
                || chr(9) || t_parse_ms || chr(9) || links_found || chr(9) || links_enqueued || chr(9)
                || CASE WHEN rule = 109 THEN 'x' ELSE html_truncated::VARCHAR END
                || CASE WHEN rule = 113 THEN chr(9) || '7' ELSE '' END
                ELSE '' END END AS line
        FROM ruled
        UNION ALL SELECT log, -1, 'timestamp' || chr(9) || 'url' || chr(9) || 'status' FROM ends
        UNION ALL SELECT log, last + 1, '' FROM ends
        UNION ALL SELECT log, last + 2, 'STAT' || chr(9) || 'pages_crawled' || chr(9) || '1' FROM ends
        UNION ALL SELECT log, last + 3, 'STAT' || chr(9) || 'pages_crawled' || chr(9) || n FROM ends
        UNION ALL SELECT log, last + 4, 'STAT' || chr(9) || 'total_bytes' || chr(9) || 'n/a' FROM ends
        UNION ALL SELECT log, last + 5, 'STAT' || chr(9) || 'elapsed_sec' || chr(9) || '12.5' FROM ends
        UNION ALL SELECT log, last + 6, 'STAT' || chr(9) || 'num_404' || chr(9) || '7.9' FROM ends""",
    "split": "SELECT log, ord, line, string_split(line, chr(9)) AS f FROM raw",
    "kinds": """SELECT *, CASE WHEN line = '' THEN 'empty' WHEN f[1] = 'STAT' THEN 'stat'
        WHEN f[1] = 'timestamp' THEN 'header'
        WHEN len(f) >= 11 AND TRY_CAST(f[4] AS BIGINT) IS NOT NULL
             AND TRY_CAST(f[11] AS BIGINT) IS NOT NULL THEN 'valid'
        ELSE 'malformed' END AS kind FROM split""",
    "typed": """SELECT log, ord, f, f[1] AS ts, f[2] AS url, f[3] AS status,
        greatest(0, TRY_CAST(f[4] AS BIGINT)) AS bytes, TRY_CAST(f[5] AS INTEGER) AS depth,
        TRY_CAST(f[6] AS DOUBLE) AS priority, f[7] AS domain, TRY_CAST(f[8] AS BIGINT) AS domain_count,
        f[9] AS superdomain, TRY_CAST(f[10] AS BIGINT) AS super_count,
        greatest(0, TRY_CAST(f[11] AS BIGINT)) AS elapsed_ms
        FROM kinds WHERE kind = 'valid'""",
    "tail": """SELECT *, len(f) >= 18
        AND TRY_CAST(f[-6] AS BIGINT) IS NOT NULL AND TRY_CAST(f[-5] AS BIGINT) IS NOT NULL
        AND TRY_CAST(f[-4] AS BIGINT) IS NOT NULL AND TRY_CAST(f[-3] AS BIGINT) IS NOT NULL
        AND TRY_CAST(f[-2] AS BIGINT) IS NOT NULL AND TRY_CAST(f[-1] AS BIGINT) IS NOT NULL
        AS debug_ok FROM typed""",
    "tailed": """SELECT *,
        CASE WHEN debug_ok THEN greatest(0, TRY_CAST(f[-6] AS BIGINT)) END AS t_connect_ms,
        CASE WHEN debug_ok THEN greatest(0, TRY_CAST(f[-5] AS BIGINT)) END AS t_read_ms,
        CASE WHEN debug_ok THEN greatest(0, TRY_CAST(f[-4] AS BIGINT)) END AS t_parse_ms,
        CASE WHEN debug_ok THEN greatest(0, TRY_CAST(f[-3] AS BIGINT)) END AS links_found,
        CASE WHEN debug_ok THEN greatest(0, TRY_CAST(f[-2] AS BIGINT)) END AS links_enqueued,
        CASE WHEN debug_ok THEN CAST(TRY_CAST(f[-1] AS BIGINT) <> 0 AS INTEGER) END AS html_truncated
        FROM tail""",
    "stat_lines": """SELECT log, f[2] AS key, arg_max(f[3], ord) AS value FROM kinds
        WHERE kind = 'stat' AND len(f) >= 3 GROUP BY log, f[2]""",
    "stat_of_lines": """SELECT log,
        max(TRY_CAST(value AS DOUBLE)) FILTER (key = 'pages_crawled') AS pages_crawled,
        max(TRY_CAST(value AS DOUBLE)) FILTER (key = 'total_bytes') AS total_bytes,
        max(TRY_CAST(value AS DOUBLE)) FILTER (key = 'elapsed_sec') AS elapsed_sec,
        max(TRY_CAST(value AS DOUBLE)) FILTER (key = 'rate_pages_per_sec') AS rate_pages_per_sec,
        max(TRY_CAST(value AS DOUBLE)) FILTER (key = 'num_404') AS num_404,
        max(TRY_CAST(value AS DOUBLE)) FILTER (key = 'num_403') AS num_403
        FROM stat_lines GROUP BY log""",
    "overlay": """SELECT r.log,
        coalesce(CAST(trunc(s.pages_crawled) AS BIGINT), r.row_pages) AS pages_crawled,
        coalesce(CAST(trunc(s.total_bytes) AS BIGINT), r.row_bytes) AS total_bytes,
        coalesce(s.elapsed_sec, 0.0) AS elapsed_sec,
        coalesce(s.rate_pages_per_sec, 0.0) AS rate_pages_per_sec,
        coalesce(CAST(trunc(s.num_404) AS BIGINT), 0) AS num_404,
        coalesce(CAST(trunc(s.num_403) AS BIGINT), 0) AS num_403,
        r.row_pages, r.total_success, r.avg_elapsed_ms
        FROM (SELECT log, count(*) AS row_pages, CAST(sum(bytes) AS BIGINT) AS row_bytes,
              avg(elapsed_ms) AS avg_elapsed_ms,
              count(*) FILTER (status = '200') AS total_success FROM typed GROUP BY log) r
        LEFT JOIN stat_of_lines s USING (log)""",
    "stats": """SELECT log, count(*) AS pages_crawled, CAST(sum(bytes) AS BIGINT) AS total_bytes,
        date_diff('microsecond', min(ts), max(ts)) / 1000000.0::DOUBLE AS elapsed_sec,
        count(*) FILTER (status = 404) AS num_404, count(*) FILTER (status = 403) AS num_403,
        count(*) FILTER (status = 200) AS total_success, avg(elapsed_ms) AS avg_elapsed_ms
        FROM log GROUP BY log""",
    "summary": """SELECT log, pages_crawled AS pages, total_success,
        pages_crawled - total_success AS total_failure,
        round(100.0 * total_success / pages_crawled, 2) AS success_rate_pct, total_bytes,
        round(elapsed_sec, 3) AS elapsed_sec,
        round(pages_crawled / elapsed_sec, 2) AS rate_official,
        round(1000.0 / avg_elapsed_ms, 2) AS rate_recomputed, num_404, num_403 FROM stats""",
    "variants": """SELECT page_id, CASE page_id % 8
          WHEN 1 THEN upper(o) || r WHEN 2 THEN o || ':80' || r WHEN 3 THEN o || ':443' || r
          WHEN 4 THEN o || ':8080' || r WHEN 5 THEN u || '#frag' WHEN 6 THEN u || ';v=1?a=1'
          WHEN 7 THEN u || '.JPG' ELSE u END || t AS raw
        FROM (SELECT page_id, u, t, regexp_extract(u, '^([^:]*://[^/]*)', 1) AS o,
                     regexp_extract(u, '^[^:]*://[^/]*(.*)$', 1) AS r
              FROM (SELECT page_id, regexp_extract(url, '^([^?#]*)', 1) AS u,
                           regexp_extract(url, '^[^?#]*(.*)$', 1) AS t FROM pages))""",
    "suffixed": """SELECT page_id, CASE page_id % 8
          WHEN 1 THEN upper(o) || r WHEN 2 THEN o || ':80' || r WHEN 3 THEN o || ':443' || r
          WHEN 4 THEN o || ':8080' || r WHEN 5 THEN u || '#frag' WHEN 6 THEN u || ';v=1?a=1'
          WHEN 7 THEN u || '.JPG' ELSE u END || t AS raw
        FROM (SELECT page_id, u, t, regexp_extract(u, '^([^:]*://[^/]*)', 1) AS o,
                     regexp_extract(u, '^[^:]*://[^/]*(.*)$', 1) AS r
              FROM (SELECT page_id, regexp_extract(url, '^([^?#]*)', 1)
                    || CASE page_id % 3 WHEN 0 THEN '.pdf' WHEN 1 THEN '.html' ELSE '' END AS u,
                           regexp_extract(url, '^[^?#]*(.*)$', 1) AS t FROM pages))""",
    "parts": """SELECT page_id, raw, d, lower(regexp_extract(d, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) AS scheme,
        lower(regexp_extract(d, '//([^/?#:]*)', 1)) AS host,
        TRY_CAST(regexp_extract(d, '//[^/?#:]*:([0-9]*)', 1) AS INTEGER) AS port,
        regexp_replace(regexp_extract(d, '//[^/?#]*([^?#]*)', 1), ';[^/]*$', '') AS path,
        regexp_extract(d, '[?](.*)$', 1) AS query
        FROM (SELECT page_id, raw, regexp_replace(raw, '#.*$', '') AS d FROM variants)""",
    "canon": """SELECT page_id, raw, host, scheme || '://' || host
        || CASE WHEN port IS NULL OR port = 0 OR (scheme = 'http' AND port = 80)
                  OR (scheme = 'https' AND port = 443) THEN '' ELSE ':' || port END
        || CASE WHEN path = '' THEN '/' ELSE path END
        || CASE WHEN query = '' THEN '' ELSE '?' || query END AS url FROM parts""",
    "hrefs": f"""SELECT page_id, url, base, unnest({_HREFS}) AS href,
        generate_subscripts({_HREFS}, 1) AS i FROM clean""",
    "resolved": """SELECT page_id, url, i - 1 AS pos, href,
        regexp_extract(url, '^([^:]*://[^/?]*)', 1)
        || regexp_replace(replace(href, '&amp;', '&'), '#.*$', '') AS dst FROM hrefs""",
    "links": """SELECT page_id, url, dst,
        CAST(row_number() OVER (PARTITION BY page_id ORDER BY min(pos)) - 1 AS BIGINT) AS pos
        FROM resolved GROUP BY page_id, url, dst""",
    # Hrefs that damaged_pages adds: as the parser that takes the last of two hrefs reads them, and as the
    # one that takes the first does; a page broken off keeps none of its own.
    "added": """SELECT page_id, page_id % 8 AS k, page_id % 8 = 7 AS behind, page_id % 8 = 6 AS broken,
        CASE page_id % 8 WHEN 0 THEN ['/u'] WHEN 1 THEN ['/s'] WHEN 2 THEN ['/e'] WHEN 3 THEN ['/two']
          WHEN 4 THEN ['/q'] WHEN 5 THEN ['/g', '/h'] WHEN 6 THEN ['/b'] ELSE ['/y'] END AS names FROM pages""",
    "added_hrefs": """SELECT page_id, k, behind, names[i] || page_id || CASE WHEN k = 2 THEN '?a=1&b=2' ELSE '' END AS href,
        i - 1 AS i, len(names) AS n FROM (SELECT *, unnest(range(1, len(names) + 1)) AS i FROM added)""",
    "own_hrefs": """SELECT page_id, replace(href, '&amp;', '&') AS href, dst, pos FROM resolved
        WHERE page_id % 8 <> 6""",
    "own_counts": "SELECT page_id, count(*) AS n FROM own_hrefs GROUP BY page_id",
    "damaged_hrefs": """SELECT page_id, pos + CASE WHEN behind THEN 0 ELSE len(names) END AS pos, href, dst
          FROM own_hrefs JOIN added USING (page_id)
        UNION ALL SELECT a.page_id, a.i + CASE WHEN behind THEN coalesce(o.n, 0) ELSE 0 END, a.href,
          regexp_extract(c.url, '^([^:]*://[^/?]*)', 1) || a.href
        FROM added_hrefs a JOIN clean c USING (page_id) LEFT JOIN own_counts o USING (page_id)""",
    "damaged_links": """SELECT page_id, dst, CAST(row_number() OVER (PARTITION BY page_id ORDER BY min(pos)) - 1 AS BIGINT) AS pos
        FROM damaged_hrefs GROUP BY page_id, dst""",
    "copies": f"""SELECT host, CASE kind WHEN 0 THEN 200 WHEN 1 THEN 404 WHEN 2 THEN 403 WHEN 3 THEN 503
          ELSE CASE WHEN page_id % 2 = 0 THEN 0 END END AS status, kind
        FROM (SELECT host, page_id, page_id % (p % 5 + 1) + 4 - p % 5 AS kind FROM (
          SELECT page_id, {_HOST.format("url")} AS host, min(page_id) OVER (PARTITION BY {_HOST.format("url")}) AS p
          FROM pages))""",
    "best_copy": """SELECT host, min(CASE kind WHEN 0 THEN 0 WHEN 2 THEN 1 ELSE kind + 1 END) AS best
        FROM copies GROUP BY host""",
    "hrefvar": """SELECT page_id, unnest(h) AS href, generate_subscripts(h, 1) - 1 AS pos FROM (
        SELECT page_id, ['/p' || page_id, 'HTTP://' || a || '/p' || page_id,
          'https://' || a || '/p' || page_id, 'mailto:a@' || a, '  JavaScript:go(' || page_id || ')',
          'tel:' || page_id, 'DATA:,' || page_id, 'ftp://' || a || '/p' || page_id, ''] AS h
        FROM (SELECT page_id, regexp_extract(url, '//([^/?#]*)', 1) AS a FROM pages))""",
    "seedlines": """SELECT page_id * 7 + k AS ord, line FROM (
        SELECT page_id, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS k FROM (
          SELECT page_id, ['# page ' || page_id, '', '  ' || u || '  ', u || 'x  # note', u || 'x',
            '   ', h] AS l
          FROM (SELECT page_id, url AS u,
                       regexp_extract(url, '//([^/?#]*)', 1) AS h FROM pages)))""",
    "cand0": """SELECT e.event_id, coalesce(c.url, 'https://missing.example.com/'
          || (e.event_id % (2 * (SELECT n FROM n)))) AS url,
        CASE WHEN e.event_id % 4 < 2 THEN 'text/html; charset=utf-8'
             WHEN e.event_id % 4 = 2 THEN 'application/json' ELSE '' END AS ct,
        CAST(e.event_id % 12 AS INTEGER) AS depth
        FROM events e LEFT JOIN clean c ON c.page_id = e.event_id % (2 * (SELECT n FROM n))""",
    "cand": f"""SELECT *, {_HOST.format("url")} AS domain,
        {_SUPER.format(_HOST.format("url"))} AS superdomain FROM cand0""",
    "snap": """SELECT url, arg_min(strlen(html), page_id) AS bytes FROM clean GROUP BY url""",
    "sizes": f"""SELECT {_HOST.format("url")} AS domain, count(*) AS n FROM pages GROUP BY 1""",
    "fails": f"""SELECT domain, count(*) FILTER ({_FAIL}) AS failures FROM log GROUP BY domain""",
    "counts": "SELECT domain, superdomain, count(*) AS n FROM log GROUP BY domain, superdomain",
    "supers": "SELECT superdomain, sum(n) AS n FROM counts GROUP BY superdomain",
    "targets": """SELECT page_id AS a, 1 AS k, page_id + 1 AS b FROM pages
          WHERE page_id % 4 <> 3 AND page_id + 1 < (SELECT n FROM n)
        UNION ALL SELECT page_id, 2, (3 * page_id + 7) % (SELECT n FROM n) FROM pages
        UNION ALL SELECT page_id, 3, (page_id * page_id + 1) % (SELECT n FROM n) FROM pages
          WHERE page_id % 5 = 0""",
    "links_of": "SELECT a, b, row_number() OVER (PARTITION BY a ORDER BY k) - 1 AS pos FROM targets",
    "edges": f"""SELECT a, b, pos, {_NODE.format("a")} AS src, {_NODE.format("b")} AS dst FROM links_of""",
    "first_links": "SELECT DISTINCT dst AS url FROM edges WHERE pos = 0",
    "queue": """SELECT dst AS url, (a % 5) - (a % 7) * CAST(0.001 AS DOUBLE) AS priority,
        CAST(a % 5 AS INTEGER) AS depth, a * 4 + pos AS seq FROM edges""",
    "best": """SELECT url, priority, depth, seq FROM queue
        QUALIFY row_number() OVER (PARTITION BY url ORDER BY priority, depth, seq) = 1""",
    "walk": """SELECT min(page_id) AS a, 0 AS d FROM pages
        UNION SELECT l.b, w.d + 1 FROM walk w JOIN links_of l ON l.a = w.a WHERE w.d < 10""",
    "bfs": f"""SELECT a, {_NODE.format("a")} AS url, min(d) AS depth, a % 17 AS h FROM walk GROUP BY a""",
    "by_host": "SELECT h, depth, count(*) AS n FROM bfs GROUP BY h, depth",
    "by_level": "SELECT depth, count(*) AS n FROM bfs GROUP BY depth",
    "hosts": f"""SELECT {_HOST.format("url")} AS host, min(page_id) % 8 AS k FROM pages GROUP BY 1""",
    "robots": """SELECT host, k, CASE k WHEN 5 THEN 503 WHEN 6 THEN 403 WHEN 7 THEN 404 ELSE 200 END AS status,
        CASE k WHEN 0 THEN 'User-agent: *' || chr(10) || 'Disallow: /de'
          WHEN 1 THEN 'User-agent: *' || chr(10) || 'Allow: /en/1' || chr(10) || 'Disallow: /en'
          WHEN 2 THEN 'User-agent: *' || chr(10) || 'Disallow: /en' || chr(10) || 'Allow: /en/1'
          WHEN 3 THEN 'User-agent: *' || chr(10) || 'Disallow: /' || chr(10) || chr(10)
            || 'User-agent: testbot' || chr(10) || 'Disallow: /es'
          WHEN 4 THEN '' END AS body FROM hosts""",
    "rlines": """SELECT host, unnest(string_split(body, chr(10))) AS line,
        generate_subscripts(string_split(body, chr(10)), 1) - 1 AS ord FROM robots WHERE status = 200""",
    "rfields": """SELECT host, ord, line, lower(regexp_extract(line, '^([^:]*):', 1)) AS field,
        trim(regexp_extract(line, '^[^:]*:(.*)$', 1)) AS value FROM rlines""",
    "rgroups": """SELECT *, sum(CASE WHEN field = 'user-agent' THEN 1 ELSE 0 END)
        OVER (PARTITION BY host ORDER BY ord) AS g,
        sum(CASE WHEN line = '' THEN 1 ELSE 0 END) OVER (PARTITION BY host ORDER BY ord) AS blanks
        FROM rfields""",
    "rrules": """SELECT r.host, CAST(r.g AS BIGINT) AS group_ord, lower(a.value) AS agent, r.ord AS rule_ord,
        r.field = 'allow' OR r.value = '' AS allow, r.value AS prefix
        FROM rgroups r JOIN rgroups a ON a.host = r.host AND a.g = r.g AND a.field = 'user-agent'
          AND a.blanks = r.blanks
        WHERE r.field IN ('allow', 'disallow')""",
    "rchosen": """SELECT host, arg_min(group_ord, CASE WHEN agent = '*' THEN 1000000 ELSE 0 END + group_ord)
        AS group_ord FROM rrules WHERE agent = '*' OR contains('testbot-1', agent) GROUP BY host""",
    "rhits": f"""SELECT p.page_id, arg_min(r.allow, r.rule_ord) AS allow FROM (
          SELECT page_id, {_HOST.format("url")} AS host,
                 regexp_extract(url, '^[^:]*://[^/?]*(.*)$', 1) AS tail FROM clean) p
        JOIN rchosen c USING (host) JOIN rrules r USING (host, group_ord)
        WHERE starts_with(p.tail, r.prefix) GROUP BY p.page_id""",
    "long": """SELECT log, 't_connect_ms' AS phase, t_connect_ms AS v FROM log WHERE debug_ok
        UNION ALL SELECT log, 't_read_ms', t_read_ms FROM log WHERE debug_ok
        UNION ALL SELECT log, 't_parse_ms', t_parse_ms FROM log WHERE debug_ok""",
    "long_raw": """SELECT log, 't_connect_ms' AS phase, t_connect_ms AS v FROM tailed WHERE debug_ok
        UNION ALL SELECT log, 't_read_ms', t_read_ms FROM tailed WHERE debug_ok
        UNION ALL SELECT log, 't_parse_ms', t_parse_ms FROM tailed WHERE debug_ok""",
}

_NEEDS = {
    "facts": ("clean",),
    "log0": ("n", "facts"), "log1": ("log0",), "log": ("log1",), "ruled": ("log",), "ends": ("log",),
    "raw": ("ruled", "ends"), "split": ("raw",), "kinds": ("split",), "typed": ("kinds",),
    "tail": ("typed",), "tailed": ("tail",), "stat_lines": ("kinds",),
    "stat_of_lines": ("stat_lines",), "overlay": ("typed", "stat_of_lines"), "stats": ("log",),
    "summary": ("stats",), "parts": ("variants",), "canon": ("parts",), "hrefs": ("clean",),
    "resolved": ("hrefs",), "links": ("resolved",), "cand0": ("n", "clean"), "cand": ("cand0",),
    "snap": ("clean",), "fails": ("log",), "counts": ("log",), "supers": ("counts",),
    "targets": ("n",), "links_of": ("targets",), "edges": ("links_of",), "first_links": ("edges",),
    "queue": ("edges",), "best": ("queue",), "walk": ("links_of",), "bfs": ("walk",),
    "by_host": ("bfs",), "by_level": ("bfs",), "robots": ("hosts",), "rlines": ("robots",),
    "rfields": ("rlines",), "rgroups": ("rfields",), "rrules": ("rgroups",), "rchosen": ("rrules",),
    "rhits": ("clean", "rchosen"), "added_hrefs": ("added",), "own_hrefs": ("resolved",),
    "own_counts": ("own_hrefs",), "damaged_hrefs": ("own_counts", "added_hrefs", "clean"),
    "damaged_links": ("damaged_hrefs",), "best_copy": ("copies",), "long": ("log",), "long_raw": ("tailed",),
}

# Tables that later levels of a traversal read again and again.
_KEPT: set[str] = {"glinks", "gnodes", "visited"}
_DEPTH = 10


def _levels(prefix: str, upto: int, columns: str, where: str = "true") -> str:
    """Rows of the first levels of a traversal, with their depth."""
    return " UNION ALL ".join(
        f"SELECT {columns}, {d} AS depth FROM {prefix}{d} WHERE {where}" for d in range(upto + 1)
    )


# Where a URL lies in its level: the path of positions that leads to it.
_CTE["q0"] = "SELECT min(page_id) AS a, [0::BIGINT] AS path FROM pages"
for _d in range(1, _DEPTH + 1):
    _CTE[f"q{_d}"] = f"""SELECT l.b AS a, min(list_append(q.path, l.pos)) AS path
        FROM q{_d - 1} q JOIN links_of l ON l.a = q.a
        WHERE l.b NOT IN (SELECT a FROM ({_levels("q", _d - 1, "a")})) GROUP BY l.b"""
    _NEEDS[f"q{_d}"] = (f"q{_d - 1}", "links_of")
_CTE["queued"] = f"""SELECT a, {_NODE.format("a")} AS url, depth, row_number() OVER (ORDER BY depth, path) AS seq
    FROM ({_levels("q", _DEPTH, "a, path")})"""
_NEEDS["queued"] = (f"q{_DEPTH}",)
_KEPT |= {f"q{_d}" for _d in range(_DEPTH + 1)}

# A whole crawl, level by level: every level is joined to the counts of all levels before it.
_CTE |= {
    "gsnap": f"""SELECT page_id AS a, {_NODE.format("page_id")} AS url,
        CASE WHEN page_id % 11 = 5 THEN 503 WHEN page_id % 13 = 7 THEN 403 WHEN page_id % 19 = 4 THEN 404
          ELSE 200 END AS status,
        CASE WHEN page_id % 23 = 9 THEN 'application/json' ELSE 'text/html; charset=utf-8' END AS ct,
        strlen('<html><body>' || coalesce(x.anchors, '') || '<hr>' || html) AS bytes
        FROM pages LEFT JOIN (SELECT a, string_agg('<a href="' || dst || '">x</a>', ' ' ORDER BY pos) AS anchors
          FROM edges GROUP BY a) x ON x.a = page_id""",
    "glinks": f"""SELECT a, dst, min(pos) AS pos FROM (
          SELECT a, dst, pos FROM edges UNION ALL
          SELECT page_id, regexp_extract({_NODE.format("page_id")}, '^([^:]*://[^/?]*)', 1)
            || regexp_replace(replace(href, '&amp;', '&'), '#.*$', ''), 100 + i FROM hrefs) GROUP BY a, dst""",
    "gurls": f"""SELECT DISTINCT u AS url, {_HOST.format("u")} AS domain, {_SUPER.format(_HOST.format("u"))} AS superdomain,
        regexp_extract(u, '^[^:]*://[^/?]*(.*)$', 1) AS tail
        FROM (SELECT dst AS u FROM glinks UNION ALL SELECT {_NODE.format("min(page_id)")} FROM pages)""",
    "ghosts": f"SELECT {_HOST.format(_NODE.format('page_id'))} AS domain, min(page_id) AS p FROM pages GROUP BY 1",
    "gnodes": f"""SELECT url, domain, superdomain, a, coalesce(status, 0) AS status, coalesce(ct, '') AS ct,
        coalesce(bytes, 0) AS bytes, NOT {_EXT.format("url")} AS allowed,
        CASE WHEN p IS NULL OR p IN (5, 6) THEN true WHEN p = 8 THEN false
          WHEN p = 1 THEN starts_with(tail, '/p/7')
          WHEN p = 2 THEN NOT starts_with(tail, '/p/2') AND starts_with(tail, '/p/1')
          ELSE starts_with(tail, '/p/9') END AS refused
        FROM gurls LEFT JOIN gsnap USING (url) LEFT JOIN ghosts USING (domain)""",
}
_NEEDS |= {
    "gsnap": ("edges",), "glinks": ("edges", "hrefs"), "gurls": ("glinks",), "gnodes": ("gurls", "gsnap", "ghosts"),
}
_PRIORITY = "{d} - 0.001::DOUBLE * (1.0::DOUBLE / log2(2 + {h}) + 0.3::DOUBLE / log2(2 + {s}))"
_PARSED = "NOT refused AND status = 200 AND starts_with(ct, 'text/html') AND bytes > 0"
for _d in range(_DEPTH + 1):
    if _d == 0:
        _first = f"SELECT {_NODE.format('min(page_id)')} AS url, [0::DOUBLE] AS path FROM pages"
        _state = "SELECT NULL AS domain, NULL AS superdomain, 0 AS n, 0 AS failures WHERE false"
        _before = "SELECT NULL AS url WHERE false"
    else:
        _first = f"""SELECT l.dst AS url, min(list_append(c.place, l.pos::DOUBLE)) AS path
            FROM crawl{_d - 1} c JOIN glinks l ON l.a = c.a WHERE {_PARSED} GROUP BY l.dst"""
        _state = f"""SELECT domain, superdomain, count(*) AS n, count(*) FILTER ({_FAIL}) AS failures
            FROM ({_levels("crawl", _d - 1, "domain, superdomain, status", "NOT refused")}) GROUP BY ALL"""
        _before = f"SELECT url FROM ({_levels('crawl', _d - 1, 'url')})"
        _NEEDS[f"crawl{_d}"] = (f"state{_d}",)
        _NEEDS[f"state{_d}"] = (f"crawl{_d - 1}",)
    _CTE[f"state{_d}"] = _state
    _CTE[f"crawl{_d}"] = f"""SELECT *, list_prepend(priority, path) AS place FROM (
        SELECT n.*, path, {_PRIORITY.format(d=_d, h="coalesce(h.n, 0)", s="coalesce(s.n, 0)")} AS priority
        FROM ({_first}) f JOIN gnodes n USING (url)
        LEFT JOIN (SELECT domain, n, failures FROM state{_d}) h ON h.domain = n.domain
        LEFT JOIN (SELECT superdomain, sum(n) AS n FROM state{_d} GROUP BY ALL) s ON s.superdomain = n.superdomain
        WHERE n.allowed AND coalesce(h.failures, 0) < 5 AND n.url NOT IN ({_before}))"""
    _KEPT |= {f"crawl{_d}", f"state{_d}"}
_NEEDS["crawl0"] = ("state0", "gnodes")
_CTE["visited"] = _levels("crawl", _DEPTH, "*")
_NEEDS["visited"] = (f"crawl{_DEPTH}",)
_CTE["down"] = f"""SELECT domain, min(depth) AS down_from FROM (
    SELECT domain, depth, sum(count(*)) OVER (PARTITION BY domain ORDER BY depth) AS upto
    FROM visited WHERE NOT refused AND {_FAIL} GROUP BY domain, depth) WHERE upto >= 5 GROUP BY domain"""
_CTE["enqueued"] = f"""SELECT v.a, count(*) AS links_found,
    count(*) FILTER (n.allowed AND coalesce(least(t.depth, down_from) > v.depth, true)) AS links_enqueued
    FROM visited v JOIN glinks l ON l.a = v.a JOIN gnodes n ON n.url = l.dst
    LEFT JOIN visited t ON t.url = l.dst LEFT JOIN down o ON o.domain = n.domain
    WHERE NOT v.refused AND v.status = 200 AND starts_with(v.ct, 'text/html') AND v.bytes > 0 AND v.depth < {_DEPTH}
    GROUP BY v.a"""
_NEEDS |= {"down": ("visited",), "enqueued": ("visited", "down")}


def _add(name: str, ctes: tuple[str, ...], body: str) -> None:
    _SQL[name] = (_with(*ctes) if ctes else "") + body


# -- sources and sinks -----------------------------------------------------------------------

_add("seed_source", ("seedlines",),
     "SELECT ord, trim(line) AS url FROM seedlines WHERE trim(line) <> '' AND NOT starts_with(trim(line), '#')")
_add("page_snapshot", (), """SELECT page_id, url, CAST(200 AS INTEGER) AS status, 'text/html' AS ct,
    CAST(strlen(html) AS BIGINT) AS bytes, CAST(0 AS BIGINT) AS elapsed_ms FROM pages""")
_add("snapshot_lookup", ("cand", "snap"), """SELECT event_id, c.url,
    CASE WHEN s.url IS NULL THEN 0 ELSE 200 END AS status, coalesce(CAST(s.bytes AS BIGINT), 0) AS bytes,
    CASE WHEN s.url IS NULL THEN '' ELSE 'text/html' END AS ct, CAST(0 AS BIGINT) AS elapsed_ms
    FROM cand c LEFT JOIN snap s ON s.url = c.url""")
_add("log_source", ("typed",), """SELECT log, ord, ts, url, status, bytes, depth,
    round(priority, 6) AS priority, domain, domain_count, superdomain, super_count, elapsed_ms FROM typed""")
_add("log_debug_tail", ("tailed",), """SELECT log, ord, bytes, debug_ok, t_connect_ms, t_read_ms,
    t_parse_ms, links_found, links_enqueued, html_truncated FROM tailed""")
_add("stat_source", ("stat_lines",), "SELECT log, key, value FROM stat_lines")
_add("log_source_lenient", ("typed",), """SELECT log, ord, TRY_CAST(status AS INTEGER) AS status, bytes,
    elapsed_ms FROM typed WHERE TRY_CAST(status AS INTEGER) IS NOT NULL""")
_add("multi_log_source", ("log",), """SELECT log, count(*) AS n_rows, CAST(sum(bytes) AS BIGINT) AS total_bytes,
    count(*) FILTER (debug_ok) AS debug_rows, CAST(1 AS BIGINT) AS skipped FROM log GROUP BY log""")
_add("failed_logs", ("log",), """SELECT log, 'read' AS state, count(*) AS n_rows,
    CAST(sum(bytes) AS BIGINT) AS total_bytes FROM log GROUP BY log
    UNION ALL SELECT unnest(['cut', 'plain', 'empty', 'none']),
      unnest(['damaged', 'damaged', 'empty', 'missing']), NULL, NULL""")
_add("row_quality", ("kinds",), "SELECT log, kind, count(*) AS n_lines FROM kinds GROUP BY log, kind")
_RUNNING = """count(*) OVER (PARTITION BY log, domain ORDER BY seq) AS domain_count,
    count(*) OVER (PARTITION BY log, superdomain ORDER BY seq) AS super_count"""
_add("log_roundtrip", ("log",), f"""SELECT log, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, url,
    CAST(status AS VARCHAR) AS status, bytes, depth, round(priority, 6) AS priority, domain, superdomain,
    {_RUNNING}, elapsed_ms, coalesce(t_connect_ms, 0) AS t_connect_ms, coalesce(t_read_ms, 0) AS t_read_ms,
    coalesce(t_parse_ms, 0) AS t_parse_ms, coalesce(links_found, 0) AS links_found,
    coalesce(links_enqueued, 0) AS links_enqueued, coalesce(html_truncated, 0) AS html_truncated FROM log""")
_add("stat_rows", ("stats",), """SELECT log, 'pages_crawled' AS key, pages_crawled::VARCHAR AS value FROM stats
    UNION ALL SELECT log, 'total_bytes', total_bytes::VARCHAR FROM stats
    UNION ALL SELECT log, 'elapsed_sec', printf('%.3f', elapsed_sec) FROM stats
    UNION ALL SELECT log, 'rate_pages_per_sec', printf('%.2f', pages_crawled / elapsed_sec) FROM stats
    UNION ALL SELECT log, 'num_404', num_404::VARCHAR FROM stats
    UNION ALL SELECT log, 'num_403', num_403::VARCHAR FROM stats""")
_add("run_summary", ("summary",), "SELECT * FROM summary")
_add("run_summary_append", ("summary",), "SELECT * FROM summary UNION ALL SELECT * FROM summary")

# -- links and URLs --------------------------------------------------------------------------

for _name in ("extract_links", "extract_links_fast", "stream_links"):
    _add(_name, ("links",), "SELECT page_id, pos, dst FROM links")
_add("extract_links_auto", ("links",), "SELECT page_id, 'robust' AS parser_used, pos, dst FROM links")
_add("damaged_links", ("damaged_links",), "SELECT page_id, pos, dst FROM damaged_links")
_add("damaged_links_fast", ("damaged_links",), """SELECT page_id, pos,
    CASE WHEN page_id % 8 = 3 AND pos = 0 THEN replace(dst, '/two', '/one') ELSE dst END AS dst FROM damaged_links""")
_add("damaged_links_auto", ("damaged_links",), """SELECT page_id, pos, dst,
    CASE WHEN page_id % 8 = 6 THEN 'fast' ELSE 'robust' END AS parser_used FROM damaged_links""")
_add("damaged_hrefs", ("damaged_hrefs",), "SELECT page_id, CAST(pos AS BIGINT) AS pos, href, dst FROM damaged_hrefs")
_add("damaged_dedupe", ("damaged_hrefs",), """SELECT page_id, CAST(sum(n) AS BIGINT) AS n_links, count(*) AS n_distinct,
    string_agg(href, ' ' ORDER BY pos) AS links
    FROM (SELECT page_id, href, min(pos) AS pos, count(*) AS n FROM damaged_hrefs GROUP BY page_id, href)
    GROUP BY page_id""")
_add("navigable_hrefs", ("hrefvar",), """SELECT page_id, pos, href FROM hrefvar
    WHERE href <> '' AND NOT regexp_matches(lower(trim(href)), '^(javascript|mailto|tel|data):')""")
_add("http_only", ("hrefvar",), """SELECT page_id, pos,
    lower(regexp_extract(href, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) IN ('http', 'https') AS by_scheme,
    starts_with(href, 'http://') OR starts_with(href, 'https://') AS literal FROM hrefvar""")
_add("resolve_links", ("hrefs",), """SELECT page_id, i - 1 AS pos, href,
    regexp_extract(url, '^([^:]*://[^/?]*)', 1) || regexp_replace(href, '#.*$', '') AS dst FROM hrefs""")
# A URL that is put together again without its fragment has its scheme in lower case.
_add("defragment", ("variants",), """SELECT page_id, raw, CASE WHEN contains(raw, '#')
    THEN lower(regexp_extract(raw, '^([^:]*)', 1)) || regexp_extract(raw, '^[^:]*(:[^#]*)', 1)
    ELSE raw END AS url FROM variants""")
_add("dedupe_links", ("hrefs",), f"""SELECT p.page_id, CAST(len({_HREFS}) AS BIGINT) AS n_links,
    CAST(len(list_distinct({_HREFS})) AS BIGINT) AS n_distinct, coalesce(d.links, '') AS links
    FROM pages p LEFT JOIN (SELECT page_id, string_agg(href, ' ' ORDER BY i) AS links
      FROM (SELECT page_id, href, min(i) AS i FROM hrefs GROUP BY page_id, href) GROUP BY page_id) d
    USING (page_id)""")
_add("decode_html", (), """SELECT page_id, CAST(length(html) + 1 AS BIGINT) AS n_chars,
    md5(html || '(') AS digest FROM pages""")
_add("html_cap", (), """SELECT page_id, CAST(least(strlen(html), 4096) AS BIGINT) AS bytes_kept,
    CAST(strlen(html) AS BIGINT) AS bytes, strlen(html) >= 4096 AS html_truncated FROM pages""")
_add("body_policy", (), """SELECT page_id, CAST(least(strlen(html),
    CASE WHEN page_id % 4 < 2 THEN 8192 ELSE 4096 END) AS BIGINT) AS bytes_kept FROM pages""")
_add("canonicalize_urls", ("canon",), "SELECT page_id, raw, url FROM canon")
_add("url_domains", ("canon",), "SELECT page_id, host AS domain FROM canon")
_add("url_superdomains", ("canon",), f"SELECT page_id, {_SUPER.format('host')} AS superdomain FROM canon")
_add("url_parts", ("parts",), "SELECT page_id, scheme, host, port, path, query FROM parts")
_add("link_edges", ("links",), "SELECT url AS src, CAST(1 AS INTEGER) AS depth, pos, dst FROM links")
_add("page_link_counts", ("links", "fails"), f"""SELECT l.url AS src, count(*) AS links_found,
    count(*) FILTER (NOT {_EXT.format("l.dst")} AND l.dst NOT IN (SELECT url FROM clean)
      AND {_HOST.format("l.dst")} NOT IN (SELECT domain FROM fails WHERE failures >= 30)) AS links_enqueued
    FROM links l GROUP BY l.url""")
_add("superdomain_links", ("facts", "links"), """SELECT f.superdomain, count(*) AS pages,
    CAST(sum(coalesce(l.n, 0)) AS BIGINT) AS links FROM facts f
    LEFT JOIN (SELECT page_id, count(*) AS n FROM links GROUP BY page_id) l USING (page_id)
    GROUP BY f.superdomain""")

# -- frontier and robots ---------------------------------------------------------------------

_SQL["ext_filter"] = (
    "WITH variants AS (" + _CTE["suffixed"] + "), parts AS (" + _CTE["parts"] + "), canon AS ("
    + _CTE["canon"] + ") SELECT page_id, url FROM canon WHERE NOT " + _EXT.format("url")
)
_add("skip_domains", ("cand", "sizes"), """SELECT event_id, url, domain FROM cand WHERE domain NOT IN
    (SELECT domain FROM sizes WHERE n < (SELECT avg(n) FROM sizes))""")
_add("domain_backoff", ("cand", "fails"), """SELECT CAST(5 AS BIGINT) AS threshold, event_id, domain FROM cand
    WHERE domain NOT IN (SELECT domain FROM fails WHERE failures >= 5)
    UNION ALL SELECT 30, event_id, domain FROM cand
    WHERE domain NOT IN (SELECT domain FROM fails WHERE failures >= 30)""")
_add("visited_filter", ("edges", "first_links"), """SELECT src, pos, dst AS url FROM edges
    WHERE dst NOT IN (SELECT url FROM first_links)""")
_add("seen_urls", ("edges", "first_links"), """SELECT src, pos, dst AS url FROM edges
    WHERE dst IN (SELECT url FROM first_links)""")
_add("parse_eligible", ("cand", "snap"), """SELECT event_id, c.url, depth FROM cand c
    JOIN snap s ON s.url = c.url WHERE starts_with(ct, 'text/html') AND depth < 10 AND s.bytes > 0""")
_SEEN = """cand c LEFT JOIN (SELECT domain, sum(n) AS n FROM counts GROUP BY domain) d USING (domain)
    LEFT JOIN supers s USING (superdomain)"""
_add("attach_counts", ("cand", "supers"), f"""SELECT event_id, CAST(coalesce(d.n, 0) AS BIGINT) AS domain_seen,
    CAST(coalesce(s.n, 0) AS BIGINT) AS super_seen FROM {_SEEN}""")
_add("novelty_priority", ("log", "supers"), """SELECT seq,
    round(depth - 0.001::DOUBLE * (1.0::DOUBLE / log2(2 + d.n) + 0.3::DOUBLE / log2(2 + s.n)), 9) AS priority
    FROM log JOIN counts d USING (domain) JOIN supers s ON s.superdomain = log.superdomain""")
_Q = "url, round(priority, 6) AS priority, depth, seq"
_add("frontier_dedupe", ("best",), f"SELECT {_Q} FROM best")
_add("frontier_order", ("queue",),
     f"SELECT row_number() OVER (ORDER BY priority, depth, seq) AS rank, {_Q} FROM queue")
_add("page_budget", ("best",), f"""SELECT row_number() OVER (ORDER BY best.priority, depth, seq) AS rank, {_Q}
    FROM best QUALIFY rank <= 100""")
_add("robots_rules", ("rrules",), "SELECT host, group_ord, agent, rule_ord, allow, prefix FROM rrules")
_add("robots_filter", ("clean", "robots", "rhits"), f"""SELECT c.page_id, c.url,
    CASE k WHEN 5 THEN false WHEN 6 THEN false WHEN 7 THEN true ELSE coalesce(h.allow, true) END AS if_deny,
    CASE k WHEN 5 THEN true WHEN 6 THEN false WHEN 7 THEN true ELSE coalesce(h.allow, true) END AS if_allow
    FROM clean c JOIN robots r ON r.host = {_HOST.format("c.url")} LEFT JOIN rhits h USING (page_id)""")
# 403 goes before 404 in their class, and refuses.
_add("robots_copies", ("clean", "best_copy"), f"""SELECT c.page_id, c.url,
    CASE best WHEN 0 THEN NOT ok WHEN 2 THEN true ELSE false END AS if_deny,
    CASE best WHEN 0 THEN NOT ok WHEN 1 THEN false ELSE true END AS if_allow
    FROM (SELECT page_id, url, {_HOST.format("url")} AS host,
            starts_with(regexp_extract(url, '^[^:]*://[^/?]*(.*)$', 1), '/en') AS ok FROM clean) c
    JOIN best_copy USING (host)""")

# -- traversal -------------------------------------------------------------------------------

_add("bfs_depths", ("bfs",), "SELECT url, CAST(depth AS BIGINT) AS depth FROM bfs")
_add("enqueue_order", ("queued",), "SELECT url, CAST(depth AS BIGINT) AS depth, seq FROM queued")
_add("crawl_order", ("queued", "by_host", "by_level"), """SELECT
    row_number() OVER (ORDER BY p, depth, seq) AS rank, url, CAST(depth AS BIGINT) AS depth,
    round(p, 9) AS priority FROM (SELECT b.url, b.depth, seq,
      b.depth - 0.001::DOUBLE * (1.0::DOUBLE / log2(2 + coalesce((SELECT sum(n) FROM by_host h
          WHERE h.h = b.a % 17 AND h.depth < b.depth), 0))
        + 0.3::DOUBLE / log2(2 + coalesce((SELECT sum(n) FROM by_level l WHERE l.depth < b.depth), 0))) AS p
      FROM queued b)""")
_add("crawl_snapshot", ("enqueued",), """SELECT seq, url, status, bytes, depth, round(priority, 9) AS priority, domain,
    row_number() OVER (PARTITION BY domain ORDER BY seq) AS domain_count, superdomain,
    row_number() OVER (PARTITION BY superdomain ORDER BY seq) AS super_count, 0 AS elapsed_ms, ct,
    0 AS t_connect_ms, 0 AS t_read_ms, 0 AS t_parse_ms, coalesce(links_found, 0) AS links_found,
    coalesce(links_enqueued, 0) AS links_enqueued, 0 AS html_truncated
    FROM (SELECT *, row_number() OVER (ORDER BY depth, place) AS seq FROM visited WHERE NOT refused)
    LEFT JOIN enqueued USING (a)""")
_add("crawl_blocked", ("visited",), "SELECT url, domain, depth FROM visited WHERE refused")
_add("redirects", ("clean",), """SELECT c.page_id, c.url, coalesce(r.to, c.url) AS final_url FROM clean c LEFT JOIN (
      SELECT url, arg_min(page_id, page_id) AS p,
        regexp_extract(url, '^([^:]*://[^/]*)', 1) || '/to/' || min(page_id) AS to FROM clean GROUP BY url) r
    ON r.url = c.url AND r.p % 3 = 0""")

# -- statistics ------------------------------------------------------------------------------

_add("log_totals", ("log",), """SELECT log, count(*) AS pages, CAST(sum(bytes) AS BIGINT) AS total_bytes,
    CAST(sum(elapsed_ms) AS BIGINT) AS total_elapsed_ms, round(avg(elapsed_ms), 6) AS avg_elapsed_ms,
    CAST(floor(avg(bytes)) AS BIGINT) AS avg_bytes FROM log GROUP BY log""")
_add("crawl_stats", ("stats",), """SELECT log, pages_crawled, total_bytes, round(elapsed_sec, 6) AS elapsed_sec,
    num_404, num_403, round(pages_crawled / elapsed_sec, 6) AS rate_pages_per_sec FROM stats""")
_add("stat_overlay", ("overlay",), """SELECT log, pages_crawled, total_bytes, round(elapsed_sec, 6) AS elapsed_sec,
    round(rate_pages_per_sec, 6) AS rate_pages_per_sec, num_404, num_403, row_pages, total_success,
    round(avg_elapsed_ms, 6) AS avg_elapsed_ms FROM overlay""")
_add("success_rate", ("stats",), """SELECT log, pages_crawled AS pages, total_success,
    pages_crawled - total_success AS total_failure,
    round(100.0 * total_success / pages_crawled, 6) AS success_rate_pct FROM stats""")
_add("recomputed_rate", ("log",), """SELECT log, round(avg(elapsed_ms), 6) AS avg_elapsed_ms,
    round(1000.0 / avg(elapsed_ms), 6) AS rate_recomputed FROM log GROUP BY log""")
_add("status_distribution", ("log",), """SELECT log, rank, status, n, round(100.0 * n / pages, 6) AS share_pct FROM (
    SELECT log, status, n, row_number() OVER (PARTITION BY log ORDER BY n DESC, status) AS rank,
      CAST(sum(n) OVER (PARTITION BY log) AS BIGINT) AS pages
    FROM (SELECT log, status, count(*) AS n FROM log GROUP BY log, status)) WHERE rank <= 10""")
_add("top_domains", ("log",), """SELECT log, rank, domain, n FROM (
    SELECT *, row_number() OVER (PARTITION BY log ORDER BY n DESC, domain) AS rank
    FROM (SELECT log, domain, count(*) AS n FROM log WHERE domain <> '' GROUP BY log, domain)) WHERE rank <= 10""")
_P95 = """SELECT log, phase, min(CASE WHEN c >= n // 2 + n % 2 THEN v END) AS low,
      min(CASE WHEN c >= n // 2 + 1 THEN v END) AS high, n,
      least(greatest(95 * (n + 1) // 100, 1), n - 1) AS j,
      min(CASE WHEN c >= least(greatest(95 * (n + 1) // 100, 1), n - 1) THEN v END) AS x0,
      min(CASE WHEN c >= least(greatest(95 * (n + 1) // 100, 1), n - 1) + 1 THEN v END) AS x1
    FROM (SELECT log, phase, v, row_number() OVER (PARTITION BY log, phase ORDER BY v) AS c,
          count(*) OVER (PARTITION BY log, phase) AS n FROM {0}) GROUP BY log, phase, n"""
_P = "(x0 * (100 - (95 * (n + 1) - 100 * j)) + x1 * (95 * (n + 1) - 100 * j)) // 100 AS p95"
_add("phase_p50", ("long",), f"SELECT log, phase, (low + high) // 2 AS p50 FROM ({_P95.format('long')})")
_add("phase_p95", ("long",), f"SELECT log, phase, {_P} FROM ({_P95.format('long')})")
_add("report_timing", ("long_raw",),
     f"SELECT log, phase, (low + high) // 2 AS p50, {_P} FROM ({_P95.format('long_raw')})")
_add("discovery", ("log",), """SELECT log, count(*) AS debug_rows, CAST(sum(links_found) AS BIGINT) AS links_found,
    CAST(sum(links_enqueued) AS BIGINT) AS links_enqueued,
    count(*) FILTER (html_truncated <> 0) AS truncated,
    round(100.0 * count(*) FILTER (html_truncated <> 0) / count(*), 6) AS truncated_pct
    FROM log WHERE debug_ok GROUP BY log""")
_add("analyze_log", ("typed",), """SELECT t.log, t.pages, t.total_bytes, round(t.avg_ms, 6) AS avg_elapsed_ms,
    round(1000.0 / t.avg_ms, 6) AS rate_recomputed, s.rank, s.status, s.n FROM (
      SELECT log, count(*) AS pages, CAST(sum(bytes) AS BIGINT) AS total_bytes, avg(elapsed_ms) AS avg_ms
      FROM typed WHERE TRY_CAST(status AS INTEGER) IS NOT NULL GROUP BY log) t
    JOIN (SELECT *, row_number() OVER (PARTITION BY log ORDER BY n DESC, status) AS rank FROM (
      SELECT log, TRY_CAST(status AS INTEGER) AS status, count(*) AS n FROM typed
      WHERE TRY_CAST(status AS INTEGER) IS NOT NULL GROUP BY 1, 2)) s USING (log) WHERE s.rank <= 10""")
_UNIT = """CASE WHEN {0} < 1024 THEN printf('%.1f B', {0}::DOUBLE)
    WHEN {0} < 1048576 THEN printf('%.1f KB', {0} / 1024.0::DOUBLE)
    WHEN {0} < 1073741824 THEN printf('%.1f MB', {0} / 1048576.0::DOUBLE)
    WHEN {0} < 1099511627776 THEN printf('%.1f GB', {0} / 1073741824.0::DOUBLE)
    ELSE printf('%.1f TB', {0} / 1099511627776.0::DOUBLE) END"""
_add("report_summary", ("overlay",), f"""SELECT *, {_UNIT.format("total_bytes")} AS total_size,
    {_UNIT.format("avg_bytes")} AS avg_size FROM (
      SELECT log, pages_crawled AS pages, total_success, greatest(0, pages_crawled - total_success) AS total_failure,
        round(100.0 * total_success / pages_crawled, 2) AS success_rate_pct, total_bytes,
        round(elapsed_sec, 3) AS elapsed_sec, round(rate_pages_per_sec, 2) AS rate_official,
        round(1000.0 / avg_elapsed_ms, 2) AS rate_recomputed, num_404, num_403,
        total_bytes // pages_crawled AS avg_bytes FROM overlay)""")
_add("report_discovery", ("tailed",), """SELECT log, count(*) AS debug_rows, CAST(sum(links_found) AS BIGINT) AS links_found,
    CAST(sum(links_enqueued) AS BIGINT) AS links_enqueued,
    count(*) FILTER (html_truncated <> 0) AS truncated,
    round(100.0 * count(*) FILTER (html_truncated <> 0) / count(*), 6) AS truncated_pct
    FROM tailed WHERE debug_ok GROUP BY log""")
_add("report_statuses", ("overlay",), """SELECT s.log, rank, status, n, round(100.0 * n / pages, 6) AS share_pct FROM (
    SELECT *, row_number() OVER (PARTITION BY log ORDER BY n DESC, status) AS rank
    FROM (SELECT log, status, count(*) AS n FROM typed GROUP BY log, status)) s
    JOIN (SELECT log, CASE WHEN pages_crawled <> 0 THEN pages_crawled ELSE row_pages END AS pages FROM overlay) o
    ON o.log = s.log WHERE rank <= 10""")
_add("report_domains", ("typed",), """SELECT log, rank, domain, n FROM (
    SELECT *, row_number() OVER (PARTITION BY log ORDER BY n DESC, domain) AS rank
    FROM (SELECT log, domain, count(*) AS n FROM typed WHERE domain <> '' GROUP BY log, domain)) WHERE rank <= 10""")
_add("fmt_bytes", ("log",), f"""SELECT seq, {_UNIT.format("b")} AS size FROM (
    SELECT seq, bytes * [1, 1000, 1000000, 1000000000][seq % 4 + 1] AS b FROM log)""")
_add("domain_counts", ("log",), """SELECT log, superdomain, domain, n AS domain_count,
    CAST(sum(n) OVER (PARTITION BY log, superdomain) AS BIGINT) AS super_count
    FROM (SELECT log, superdomain, domain, count(*) AS n FROM log GROUP BY log, superdomain, domain)""")
_add("status_class", ("log",), f"""SELECT log, class, count(*) AS n, count(*) FILTER ({_FAIL}) AS n_backoff FROM (
    SELECT *, CASE WHEN status = 200 THEN 'success' WHEN status = 404 THEN 'not_found'
      WHEN status = 403 THEN 'forbidden' WHEN {_FAIL} THEN 'backoff' ELSE 'other' END AS class FROM log)
    GROUP BY log, class""")
_add("running_domain_counts", ("log",),
     f"SELECT log, seq, domain, superdomain, {_RUNNING} FROM log")
_add("running_backoff", ("log",), f"""SELECT *, earlier_failures >= 5 AS blocked FROM (
    SELECT log, seq, domain, CAST(coalesce(sum(CAST({_FAIL} AS INTEGER)) OVER (PARTITION BY log, domain
      ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS earlier_failures FROM log)""")

# -- streaming -------------------------------------------------------------------------------

_add("stream_totals", ("stats",), "SELECT log, pages_crawled, total_bytes, num_404, num_403 FROM stats")
_add("stream_dedupe", ("log",), "SELECT DISTINCT url FROM log")
_add("stream_dedupe_bounded", ("log",), """SELECT DISTINCT url, time_bucket(INTERVAL '1 day', ts::TIMESTAMP) AS since
    FROM log""")
_add("stream_domain_state", ("log",), f"""SELECT domain, count(*) AS pages, count(*) FILTER ({_FAIL}) AS failures,
    count(*) FILTER ({_FAIL}) >= 30 AS blocked FROM log GROUP BY domain""")
