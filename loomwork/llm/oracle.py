"""DuckDB SQL for those queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACE = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"

def _either(word: str) -> str:
    """An expression of the word in letters of either case, and of no other that folds to them."""
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_KEYS = "|".join(_either(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
#: Of the secret rules: kind, expression, group that must be so long at least.
_SECRETS = (
    ("assign", f"""({_KEYS})["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", "AKIA[A-Z0-9]+", 0, 18),
    ("hex", "[0-9a-f]{16,}", 0, 16),
    ("private", "-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----(?:[^-]*-----END (?:[A-Z]+ )*PRIVATE KEY-----)?", 0, 0),
    ("forge", "gh[opsu]_[A-Za-z0-9]{36,}", 0, 0),
    ("chat", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
)
_FOUND = " union all ".join(
    f"select doc_id, {k} as ord, '{kind}' as kind, {least} as least, regexp_extract_all(t, '{rx}') as m, regexp_extract_all(t, '{rx}', {group}) as g, regexp_split_to_array(t, '{rx}') as p from d where regexp_matches(t, '{rx}')"
    for k, (kind, rx, group, least) in enumerate(_SECRETS)
)

#: Of the quality rules: numerator, denominator, share of the risk.
_RULES = (("symbols", "n_symbols", "n_words", 0.6), ("repeats", "n_repeat_words", "n_words", 0.2), ("dup_lines", "n_dup_lines", "n_lines", 0.1), ("upper", "n_upper", "word_chars", 0.1))
_RATIOS = " union all ".join(f"select doc_id, stratum, base_failed, '{rule}' as rule, 0.05::double * {share}::double as risk, case when {b} > 0 then {a}::double / {b}::double else 0.0::double end as ratio from s" for rule, a, b, share in _RULES)

ORACLE: dict[str, str] = {
    "op1_decontaminate": f"""
        with d as (select doc_id, {_ALNUM} as w from documents),
        b as (select cast(item_id as varchar) as item_id, {_ALNUM} as w from benchmark),
        iw as (select distinct item_id, least(10, len(w)) as n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') as win
            from b, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) g(i) where len(w) > 0),
        lens as (select distinct n from iw),
        dw as (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as win from d, lens, unnest(generate_series(1, len(w) - n + 1)) g(i) where len(w) >= n),
        m as (select doc_id, item_id, i, n from dw join iw using (n, win)),
        h as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(generate_series(i, i + n - 1)) as p from m) group by 1),
        x as (select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as s from (select distinct doc_id, item_id from m) group by 1)
        select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(s, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
        from d left join h using (doc_id) left join x using (doc_id)""",
    "op3_neardup": f"""
        with recursive d as (select doc_id, {_SPACE} as w from documents),
        s as (select distinct doc_id, array_to_string(case when len(w) >= 3 then w[i:i + 2] else w end, ' ') as g from d, unnest(generate_series(1, greatest(len(w) - 2, 1))) t(i) where len(w) > 0),
        n as (select doc_id, count(*) as n from s group by 1),
        p as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
        e as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)),
        r(id, comp) as (select doc_id, doc_id from d union select e.a, r.comp from e join r on r.id = e.b)
        select d.doc_id, coalesce(max(n), 0) as n_shingles, min(comp) as component_id, d.doc_id = min(comp) as kept from d join r on r.id = d.doc_id left join n on n.doc_id = d.doc_id group by d.doc_id""",
    "op5_repeats": f"""
        with d as (select doc_id, {_SPACE} as w from documents),
        v as (select doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) as h from d, unnest(generate_series(1, len(w) - 49)) t(i) where len(w) >= 50),
        m as (select doc_id, i from v where h in (select h from v group by h having count(distinct doc_id) > 1)),
        g as (select doc_id, i, coalesce(i - lag(i) over (partition by doc_id order by i) > 50, false) as fresh from m),
        k as (select doc_id, i, sum(fresh::int) over (partition by doc_id order by i) as part from g)
        select doc_id, cast(min(i) - 1 as int) as start, cast(max(i) + 49 as int) as stop, max(i) - min(i) + 50 as n_words from k group by doc_id, part""",
    "op8_chat": r"""
        with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all select * from (values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')) t(conv_id, turn, role, text)),
        k as (select *, len(regexp_extract_all(role || chr(10) || text, '<\\*/?s>|\[\\*/?INST\]')) as controls from c)
        select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
        coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars, sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
        sum(20 + length(role) + length(text) + controls)::bigint as formatted_chars from k group by conv_id""",
    # the driver's pages all mark their article, once, as <article>, and hold paragraphs, a heading, bold text and line breaks in it
    "op9_html": r"""
        with a as (select page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) as x from pages),
        b as (select page_id, url, list_transform(regexp_split_to_array(x, '</?(?:p|h1)>'), lambda t: regexp_replace(t, '</?(?:b|br)>', ' ', 'g')) as parts from a),
        c as (select page_id, url, list_transform(parts, lambda t: regexp_replace(replace(replace(replace(replace(t, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&#39;', chr(39)), '&amp;?', '&', 'g')) as parts from b),
        d as (select page_id, url, array_to_string(list_filter(list_transform(parts, lambda t: trim(regexp_replace(t, '\s+', ' ', 'g'))), lambda t: t <> ''), chr(10)) as text from c)
        select page_id, url, coalesce(text, '') as text, cast(length(coalesce(text, '')) as bigint) as n_chars from d""",
    "op4_secrets": f"""
        with d as (select doc_id, coalesce(text, '') as t from documents), f as ({_FOUND}),
        s as (select doc_id, ord, kind, least, length(g[i]) as own, length(m[i]) as n, cast(list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) as bigint) as start
            from f, unnest(generate_series(1, len(m))) u(i)),
        x as (select doc_id, ord, kind, start, kind || ':' || start || ':' || (start + n) as told from s where own >= least)
        select d.doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access, count(*) filter (kind = 'hex') as n_hex,
        sha256(coalesce(string_agg(told, ',' order by start, ord) filter (ord < 3), '')) as base_sha256, coalesce(string_agg(told, ',' order by start, ord), '') as spans
        from d left join x using (doc_id) group by d.doc_id""",
    "op6_quality": f"""
        with d as (select doc_id, coalesce(lang, '') as stratum, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
        win as (select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g from d, unnest(generate_series(1, len(w) - 2)) u(i) where len(w) >= 3),
        rep as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as c from win) where c > 1),
        rw as (select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from rep) group by doc_id),
        ln as (select doc_id, count(*) as n, count(*) - count(distinct l) as dup from (select doc_id, unnest(string_split(t, chr(10))) as l from d) where regexp_matches(l, '[^\x20\x09-\x0D]') group by doc_id),
        c as (select d.doc_id, stratum, cast(len(w) as bigint) as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols, coalesce(ln.dup, 0) as n_dup_lines,
            coalesce(rw.n, 0) as n_repeat_words, coalesce(ln.n, 0) as n_lines, length(regexp_replace(t, '[^A-Z]', '', 'g')) as n_upper from d left join rw using (doc_id) left join ln using (doc_id)),
        s as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from c),
        r as ({_RATIOS}),
        told as (select doc_id, max(quality) as good from labels where doc_id is not null and quality is not null group by doc_id),
        x as (select stratum, rule, risk, least(50, floor(ratio * 50)) as bin, good > 0 as good from r join told using (doc_id) where not base_failed),
        h as (select stratum, rule, risk, i, count(*) filter (good and bin >= i) as lost, count(*) filter (not good and bin >= i) as caught, count(*) filter (good) as n_good, count(*) filter (not good) as n_bad from x, unnest(generate_series(1, 50)) u(i) group by all),
        p as (select *, case when n_good > 0 and lost < n_good * risk then list_sum(list_transform(generate_series(0, lost), lambda k: exp(lgamma(n_good + 1) - lgamma(k + 1) - lgamma(n_good - k + 1) + k * ln(risk) + (n_good - k) * ln(1 - risk)))) <= 0.05 / (4 * (select count(distinct stratum) from d)) else false end as holds from h),
        q as (select *, bool_and(holds) over (partition by stratum, rule order by i desc) as certified, caught::double / greatest(1, n_bad) - lost::double / greatest(1, n_good) as gain from p),
        cut as (select stratum, rule, arg_max(i, (round(gain, 12), i))::double / 50 as cutoff from q where certified and gain > 1e-12 group by stratum, rule),
        bad as (select distinct doc_id from r join cut using (stratum, rule) where ratio > cutoff)
        select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and doc_id not in (select doc_id from bad) as kept from s""",
}
