"""DuckDB SQL with the same rows as the queries that SQL can express."""

from __future__ import annotations

from publicspend.llm.line_cleaning import PHRASES, TERMINAL, LineRules
from publicspend.llm.url_reputation import LOWER, MARKS, RULES, UPPER, Reputation

WORD = r"[^\x20\x09-\x0D]+"


def _level(child: str, parent: str, keys: str, rules: Reputation) -> str:
    """A level of names, shrunk to the level above by its own strength."""
    low, high = rules.weakest, rules.strongest
    return f"""
        {child}_seen AS (
            SELECT c.*, p.mean AS prior FROM {child} c JOIN {parent} p USING ({keys})),
        {child}_fit AS (
            SELECT sum(n * pow(bad / n - prior, 2) - prior * (1 - prior)) AS excess,
                sum(prior * (1 - prior) * (n - 1)) AS room
            FROM {child}_seen WHERE n > 0 AND prior > 0 AND prior < 1),
        {child}_strength AS (
            SELECT coalesce(least(greatest(CASE WHEN room = 0 THEN NULL
                WHEN excess / room > 0 THEN room / excess - 1 ELSE {high} END, {low}), {high}),
                {low}) AS k FROM {child}_fit),
        {child}_post AS (
            SELECT *, prior * k + bad AS a, (1 - prior) * k + n - bad AS b, a / (a + b) AS mean
            FROM {child}_seen, {child}_strength)"""


def url_reputation(rules: Reputation = Reputation()) -> str:
    values = ", ".join(
        f"('{r.host}', '{r.path}', '{r.text}', '{r.verdict}')" for r in RULES
    )
    long = ", ".join(f"'{s}'" for s in rules.long_suffixes)
    return f"""
        WITH given AS (SELECT page_id, url, strpos(url, '://') AS mark,
                regexp_replace(html, '<[^>]*>', ' ', 'g') AS plain,
                row_number() OVER () AS row FROM pages),
        split AS (SELECT *, CASE WHEN mark > 0 THEN substr(url, mark + 3) ELSE '' END AS rest
            FROM given),
        parsed AS (
            SELECT row, page_id,
                (length(plain) - length(translate(plain, '{MARKS}', '')) > 0.02 * length(plain))::INTEGER
                    AS junk,
                translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
                regexp_extract(rest, '^[^/?#]*(/[^?#]*)?', 1) AS path FROM split),
        rules(rule_host, rule_path, rule, verdict) AS (VALUES {values}),
        ruled AS (
            SELECT p.*, rule, verdict FROM parsed p LEFT JOIN rules
                ON (host = rule_host OR ends_with(host, '.' || rule_host))
                    AND starts_with(path, rule_path)
            QUALIFY row_number() OVER (PARTITION BY row ORDER BY length(rule) DESC) = 1),
        found AS (
            SELECT host, count(junk)::DOUBLE AS n, sum(junk)::DOUBLE AS bad FROM parsed GROUP BY host),
        named AS (
            SELECT host, string_split(host, '.') AS parts,
                array_to_string(parts[-2:], '.') AS two, two IN ({long}) AS is_long,
                if(is_long, two, parts[-1]) AS suffix,
                if(is_long, array_to_string(parts[-3:], '.'), two) AS domain
            FROM (SELECT DISTINCT host FROM parsed)),
        hosts AS (
            SELECT host, domain, suffix, coalesce(n, 0) AS n, coalesce(bad, 0) AS bad
            FROM named LEFT JOIN found USING (host)),
        domains AS (
            SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY 1, 2),
        suffixes AS (SELECT suffix, 0 AS every, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY 1),
        whole AS (SELECT 0 AS every, (sum(bad) + 0.5) / (sum(n) + 1) AS mean FROM suffixes),
        {_level("suffixes", "whole", "every", rules)},
        {_level("domains", "suffixes_post", "suffix", rules)},
        {_level("hosts", "domains_post", "domain", rules)},
        judged AS (
            SELECT host, mean - {rules.deviations} * sqrt(a * b / (pow(a + b, 2) * (a + b + 1)))
                > {rules.threshold} AS block FROM hosts_post)
        SELECT page_id, host, path, rule,
            coalesce(verdict, if(block, 'block', 'allow')) AS verdict
        FROM ruled JOIN judged USING (host)"""


KD_TREES = """
    WITH finite AS (
        SELECT vec_id, [floor(256 * x::DOUBLE) for x in embedding] AS vector
        FROM embeddings
        WHERE vec_id IS NOT NULL AND len(embedding) > 0
            AND list_bool_and([x IS NOT NULL AND isfinite(x) for x in embedding])),
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id,
            list_inner_product(q.vector, c.vector)::BIGINT AS score
        FROM finite q JOIN finite c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
            AND len(q.vector) = len(c.vector))
    SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
        FROM scored) WHERE rank <= 5"""


def line_quality(rules: LineRules = LineRules()) -> str:
    phrases = "|".join(PHRASES)
    ends = "', '".join(t.replace("'", "''") for t in TERMINAL)
    space = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
        WITH given AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text
            FROM documents),
        worded AS (SELECT *, regexp_extract_all(text, '{WORD}') AS words FROM given),
        windows AS (
            SELECT row, i, words[i:i + {rules.window - 1}] AS part
            FROM worded, range(1, len(words) - {rules.window} + 2) AS t(i)),
        twice AS (
            SELECT row, i FROM windows QUALIFY count(*) OVER (PARTITION BY row, part) > 1),
        repeated AS (
            SELECT row, count(DISTINCT i + j) AS n_repeat_words
            FROM twice, range({rules.window}) AS t(j) GROUP BY row),
        lines AS (
            SELECT row, line, len(regexp_extract_all(line, '{WORD}')) AS n,
                trim(line, {space}) AS bare,
                len(regexp_extract_all(bare, '[|›»•→·]| > | / ')) AS parts
            FROM (SELECT row, unnest(string_split(text, chr(10))) AS line FROM given)
            WHERE n > 0),
        failing AS (
            SELECT *, (parts >= {rules.separators} AND n <= {rules.nav_words} * (parts + 1))
                OR (n <= {rules.short_words} AND NOT right(bare, 1) IN ('{ends}'))
                OR len(regexp_extract_all(bare, '[!?#*$%&|<>=_~^+\\\\{{}}\\[\\]]'))
                    > {rules.mark_share} * (length(bare) - len(regexp_extract_all(bare, ' ')))
                OR (n <= {rules.boiler_words} AND regexp_matches(lower(bare), '{phrases}'))
                AS fails,
                list_sum([length(w) for w in regexp_extract_all(line, '{WORD}')]) AS chars
            FROM lines),
        by_line AS (
            SELECT row, count(*) - count(DISTINCT line) AS n_dup_lines,
                coalesce(sum(chars) FILTER (WHERE fails), 0) AS lost
            FROM failing GROUP BY row),
        judged AS (
            SELECT doc_id, len(words) AS n_words,
                coalesce(list_sum([length(w) for w in words]), 0)::BIGINT AS word_chars,
                len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
                coalesce(n_dup_lines, 0) AS n_dup_lines,
                coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(lost, 0) AS lost
            FROM worded LEFT JOIN by_line USING (row) LEFT JOIN repeated USING (row))
        SELECT * EXCLUDE (lost), n_words < {rules.min_words}
                OR 100 * n_repeat_words > {rules.repeat_percent} * n_words AS base_failed,
            NOT base_failed AND lost <= {rules.lost_share} * word_chars AS kept
        FROM judged"""


PREFIX_TRIE = """
    WITH named AS (
        SELECT conv_id, turn, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS said,
            sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))
                AS code
        FROM conversations WHERE conv_id IS NOT NULL),
    own AS (
        SELECT conv_id, list(said ORDER BY turn NULLS FIRST, code) AS turns FROM named GROUP BY 1),
    codes AS (
        SELECT *, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)
            AS bytes FROM own),
    -- crc32, bit by bit
    taking AS (
        SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], bytes), lambda crc, byte:
            list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda bits, none:
                CASE WHEN bits & 1 = 1 THEN xor(bits >> 1, 3988292384) ELSE bits >> 1 END)),
            4294967295) % 9 AS h FROM codes),
    rebuilt AS (
        SELECT o.conv_id, list_concat(coalesce(b.turns[1:h], []), o.turns[h + 1:]) AS turns
        FROM taking o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5),
    prefixes AS (
        SELECT conv_id, depth, turns[1:depth] AS node, depth = len(turns) AS ends
        FROM rebuilt, unnest(range(0, len(turns) + 1)) AS u(depth)),
    nodes AS (
        SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
            coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')
                AS ends,
            if(depth > 0, strlen(node[depth].text), 0) AS bytes
        FROM prefixes GROUP BY node, depth),
    children AS (
        SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
    counted AS (
        SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (node)),
    totals AS (
        SELECT node[1:upto] AS node, sum(if(n_children = 0, 1, 0))::BIGINT AS n_leaves,
            sum((n_convs - 1) * bytes)::BIGINT AS saved_tokens
        FROM counted, unnest(range(0, depth + 1)) AS u(upto) GROUP BY 1)
    SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves,
        saved_tokens, sha256(c.ends) AS ends_sha256
    FROM counted c JOIN totals t ON t.node = c.node
    LEFT JOIN counted p ON c.depth > 0 AND p.node = c.node[1:c.depth - 1]"""


FILL_MIDDLE = r"""
    WITH given AS (
        SELECT doc_id, coalesce(text, '') AS text,
            sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS digits,
            regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units FROM documents),
    drawn AS (
        SELECT *, len(units) AS n,
            ('0x' || digits[1:8])::BIGINT % (len(units) + 1) AS one,
            ('0x' || digits[9:16])::BIGINT % (len(units) + 1) AS two,
            text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR ('0x' || digits[17:24])::BIGINT % 100 >= 100 AS is_plain,
            ('0x' || digits[25:32])::BIGINT % 100 < 50 AS is_spm FROM given),
    cut AS (
        SELECT *, array_to_string(units[1:least(one, two)], '') AS p,
            array_to_string(units[least(one, two) + 1:greatest(one, two)], '') AS m,
            array_to_string(units[greatest(one, two) + 1:], '') AS s FROM drawn)
    SELECT doc_id, n, CASE WHEN is_plain THEN 'plain' WHEN is_spm THEN 'spm' ELSE 'psm' END AS form,
        CASE WHEN NOT is_plain THEN length(p) END AS prefix_chars,
        CASE WHEN NOT is_plain THEN length(m) END AS middle_chars,
        sha256(CASE WHEN is_plain THEN text WHEN is_spm THEN '<S>' || s || '<P>' || p || '<M>' || m
            ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
        sha256(text) AS restored_sha256
    FROM cut"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_reputation": url_reputation(),
        "op7_kd_trees": KD_TREES,
        "op9_line_quality": line_quality(),
        "op11_prefix_trie": PREFIX_TRIE,
        "op13_fill_middle": FILL_MIDDLE,
    }
