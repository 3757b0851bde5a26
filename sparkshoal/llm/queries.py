"""Queries of this subpackage by name, and the SQL that gives the same rows."""

from __future__ import annotations

from sparkshoal.llm import canonical, frequency, fusion, leakage, mixing, pii, runs, splits

QUERIES = {
    "p1_found": splits.p1_found,
    "p1_splits": splits.p1_splits,
    "p1_shares": splits.p1_shares,
    "p2_found": canonical.p2_found,
    "p2_unmatched": canonical.p2_unmatched,
    "p3_found": fusion.p3_found,
    "p3_fused": fusion.p3_fused,
    "p3_checks": fusion.p3_checks,
    "p4_found": frequency.p4_found,
    "p4_terms": frequency.p4_terms,
    "p5_found": runs.p5_found,
    "p5_events": runs.p5_events,
    "p7_found": leakage.p7_found,
    "p7_leaks": leakage.p7_leaks,
    "p8_mix": mixing.p8_mix,
    "p8_shares": mixing.p8_shares,
    "p8_checks": mixing.p8_checks,
    "p9_found": pii.p9_found,
    "p9_redacted": pii.p9_redacted,
}

_SPACE = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_SEPARATOR = _SPACE[:-1] + r"_\-]"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^{_SPACE}+|{_SPACE}+$', '', 'g')"


def _group(path: str) -> str:
    stem = rf"regexp_replace(regexp_extract({path}, '[^/]*$'), '(.)\.[^.]*$', '\1')"
    return f"regexp_replace(lower({_strip(f"case when coalesce({_strip('group_key')}, '') = '' then {stem} else group_key end")}), '{_SEPARATOR}+', '-', 'g')"


_TERMS = f"""with t as (select 'label' field, label term, sample_id rec, box_id occ from boxes union all select 'concept', concept, rec_id, rec_id from progress),
u as (select * from t where coalesce({_strip('term')}, '') <> ''), n as (select field, count(distinct rec) total from u group by 1),
k as (select field, term, count(distinct (rec, occ)) occurrences, count(distinct rec) records from u group by all),
m as (select k.field, k.term, occurrences, records, case when records <= 2 then 'rare' when records > 0.04 * total then 'common' end mark from k join n using (field))"""

_UUID = "([0-9a-f]{8}-?[0-9a-f]{4}-?[0-9a-f]{4}-?[0-9a-f]{4}-?[0-9a-f]{12})"

_FRAMES = rf"""with s as (select *, row_number() over (partition by sample_id order by ingested_at nulls first, dataset nulls first, group_key nulls first, image_path nulls first, dhash nulls first, captured_at nulls first) nth from samples where sample_id is not null),
g as (select * from s where nth = 1),
k as (select *, {_group('image_path')} group_name, try_cast(regexp_extract(regexp_replace(regexp_extract(image_path, '[^/]*$'), '(.)\.[^.]*$', '\1'), '(\d+)\D*$', 1) as bigint) frame from g),
f as (select *, case when bit_count(xor(dhash, lag(dhash) over w)) <= 6 then 0 else 1 end change from k where dhash is not null and frame is not null window w as (partition by dataset, group_name order by frame, sample_id)),
r as (select *, sum(change) over (partition by dataset, group_name order by frame, sample_id) run from f)"""

# Images, their groups, the groups that one image ties together, and the greedy assignment, one group after the other.
_SPLITS = rf"""with recursive i as (select distinct coalesce(dataset, '') || chr(31) || path image, coalesce(dataset, '') || chr(31) || coalesce(g, '') node from (select dataset, image_path path, {_group('image_path')} g from samples union all select dataset, source_path, {_group('source_path')} from manifest) where path is not null),
e as (select image, min(node) a, max(node) b from i group by image), l as (select distinct a, node b from i join e using (image) where e.a <> e.b and node <> e.a), bi as (select a, b from l union select b, a from l),
c as (select a node, a other from bi union select c.node, bi.b from c join bi on bi.a = c.other), r as (select node, min(other) root from c group by node),
h as (select image, coalesce(root, a) root from e left join r on r.node = e.a), s as (select root, count(*) n from h group by root), k as (select *, row_number() over (order by n desc) i from s), t as (select sum(n) total from s),
p as (select 0::bigint i, 0::bigint n, -1 pick, total * 0.8::double a, total * 0.1::double b, total * 0.1::double c from t
  union all select i, n, pick, a - case when pick = 0 then n else 0 end, b - case when pick = 1 then n else 0 end, c - case when pick = 2 then n else 0 end from (select k.i, k.n, a, b, c, case when a >= b and a >= c then 0 when b >= c then 1 else 2 end pick from p join k on k.i = p.i + 1)),
u as (select n, count(*) filter (where pick = 0) x, count(*) filter (where pick = 1) y from p where i > 0 group by n),
z as (select root, s.n, x, y, row_number() over (partition by s.n order by ('0x' || substr(md5(root), 1, 8))::bigint % greatest(16, (select count(*) from s) // 1000000 + 1), root) rk from s join u using (n)),
f as (select image, root, case when rk <= x then 'train' when rk <= x + y then 'val' else 'test' end split from h join z using (root))"""

SQL = {
    "p1_splits": f"{_SPLITS} select split_part(image, chr(31), 1) dataset, split_part(image, chr(31), 2) image_path, split from f",
    "p1_shares": f"{_SPLITS} select split, count(*) images, count(distinct root) groups, round(count(*) / sum(count(*)) over (), 4) share from f group by split",
    "p3_checks": f"""with l as (select rec_id, replace(coalesce(nullif(regexp_extract(lower(uuid), '{_UUID}', 1), ''), nullif(regexp_extract(lower(file_name), '{_UUID}', 1), '')), '-', '') image, len(list_distinct(coalesce(boxes, []))) n from progress)
        select image, min(rec_id) first_rec_id, count(distinct rec_id) lines, max(n)::int n_boxes, true concept_claimed from l where image is not null group by image""",
    "p8_checks": f"""with w as (select source, max(target_share) share from mix_targets where source is not null and target_share > 0 group by 1), d as (select text, source, row_number() over (partition by text order by doc_id) nth from documents join w using (source) where doc_id is not null and coalesce({_strip('text')}, '') <> ''),
        p as (select source, share, exists(select 1 from d where d.source = w.source and nth = 1) there from w) select source, round(case when there then share / sum(case when there then share end) over () else 0 end, 6) attainable_share, true share_met, true cap_kept from p""",
    "p1_found": f"""with m as (select dataset, out_name, {_group('source_path')} g, lower({_strip('split')}) s from manifest)
        select dataset, min(out_name) out_name from m group by dataset, g having count(distinct case when s in ('valid', 'validation') then 'val' when s in ('train', 'val', 'test') then s end) > 1""",
    "p3_found": f"""with l as (select rec_id, logged_at, replace(coalesce(nullif(regexp_extract(lower(uuid), '{_UUID}', 1), ''), nullif(regexp_extract(lower(file_name), '{_UUID}', 1), '')), '-', '') image, len(list_distinct(coalesce(boxes, []))) n, coalesce({_strip('concept')}, '') <> '' named from progress)
        select min(rec_id) first_rec_id, arg_max(rec_id, (n, -rec_id)) boxes_rec_id, arg_max(rec_id, (coalesce(epoch_us(logged_at), -9000000000000000000), -rec_id)) filter (where named) concept_rec_id from l where image is not null group by image having count(distinct rec_id) > 1""",
    "p4_found": f"{_TERMS} select field, term, mark from m where mark is not null",
    "p4_terms": f"{_TERMS} select * from m",
    "p5_found": f"{_FRAMES} select min(sample_id) lo_sample_id, max(sample_id) hi_sample_id from r group by dataset, group_name, run having count(*) > 1",
    "p5_events": f"{_FRAMES} select dataset, group_name, min(sample_id) lo_sample_id, max(sample_id) hi_sample_id, count(*) frames, min(frame) first_frame, max(frame) last_frame, epoch_us(min(captured_at)) started_us, round((epoch_us(max(captured_at)) - epoch_us(min(captured_at))) / 1e6, 6) duration_s from r group by dataset, group_name, run having count(*) > 1",
    "p7_found": r"""with d as (select doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') w from documents where text is not null), i as (select item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') w from eval_items),
        a as (select distinct doc_id, array_to_string(w[k:k+7], ' ') s from (select *, unnest(range(1, len(w) - 6)) k from d)), b as (select distinct item_id, array_to_string(w[k:k+7], ' ') s from (select *, unnest(range(1, len(w) - 6)) k from i))
        select distinct doc_id, item_id from a join b using (s)""",
}
