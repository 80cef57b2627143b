"""The roles of `bindings.py` and shared steps as SQL common table expressions."""

from __future__ import annotations

ROLES: dict[str, tuple[tuple[str, ...], str]] = {
    "base": (
        (),
        """SELECT d.doc_id, d.text, d.lang, d.source, l.quality, l.toxic,
            CASE WHEN (d.doc_id // 20) % 5 = 0 THEN 'test' ELSE 'train' END AS split,
            CAST(substr(d.source, 4) AS INTEGER) % 5 AS label_id,
            'c' || (CAST(substr(d.source, 4) AS INTEGER) % 5) AS class_name,
            CAST(len(string_split(d.text, ' ')) AS INTEGER) AS width,
            CAST(len(list_distinct(string_split(d.text, ' '))) AS INTEGER) AS height,
            (length(d.text) - length(translate(d.text, '0123456789', ''))) / length(d.text)
                AS digit_share
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    ),
    "idx": (
        ("base",),
        """SELECT doc_id, printf('%s_%s_%06d', split, class_name, doc_id) AS image_id,
            'documents' AS source_dataset, split, class_name, label_id,
            class_name || '/' || source || '_' || doc_id || '.' || upper(lang)
                AS original_relative_path,
            'data/raw/' || split || '/' || class_name || '/'
                || printf('%s_%06d.%s', class_name, doc_id, lang) AS raw_path,
            source || '_' || doc_id || '.' || upper(lang) AS original_filename,
            printf('%s_%06d.%s', class_name, doc_id, lang) AS new_filename,
            width, height,
            CASE quality WHEN 1 THEN 3 WHEN 0 THEN 1 END AS channels,
            CASE quality WHEN 1 THEN 'RGB' WHEN 0 THEN 'L' END AS image_mode,
            lang AS image_format,
            pround(width / height, 4) AS aspect_ratio,
            CAST(width AS BIGINT) * height AS pixel_count,
            0 AS exif_tag_count,
            CAST(octet_length(encode(text)) AS BIGINT) AS file_size_bytes,
            md5(text) AS md5,
            '2026-01-01T00:00:00.000000' AS ingestion_timestamp,
            quality, toxic, digit_share
        FROM base""",
    ),
    "master": (
        ("idx",),
        """SELECT *, round(file_size_bytes / 1024, 2) AS file_size_kb,
            CASE WHEN width < 256 OR height < 256 THEN 1 ELSE 0 END AS is_small_image,
            CASE WHEN aspect_ratio > 2.5 OR aspect_ratio < 0.4 THEN 1 ELSE 0 END AS is_odd_aspect,
            CASE WHEN image_mode <> 'RGB' THEN 1 ELSE 0 END AS is_non_rgb
        FROM idx""",
    ),
    "exact_groups": (
        ("idx",),
        """SELECT 'exact:' || f.first_member AS group_id, 'exact' AS kind, i.image_id AS member,
            f.group_size
        FROM idx i JOIN (SELECT md5, count(*) AS group_size, min(image_id) AS first_member
            FROM idx GROUP BY md5 HAVING count(*) > 1) f ON i.md5 = f.md5""",
    ),
    "words": (
        (),
        """SELECT doc_id, md5(text) AS content, list_filter(
            string_split_regex(text, '[ \\t\\n\\r]+'), lambda w: w <> '') AS ws FROM documents""",
    ),
    "texts": (
        ("words",),
        """SELECT content, min(doc_id) AS node, any_value(ws) AS ws FROM words
        WHERE len(ws) > 0 GROUP BY content""",
    ),
    "shingles": (
        ("texts",),
        """SELECT DISTINCT node, unnest(list_transform(range(1, greatest(len(ws) - 1, 2)),
            lambda i: array_to_string(ws[i : i + 2], ' '))) AS token FROM texts""",
    ),
    "set_sizes": (("shingles",), "SELECT node, count(*) AS n FROM shingles GROUP BY node"),
    "links": (
        ("shingles", "set_sizes"),
        """SELECT c.a, c.b FROM (SELECT x.node AS a, y.node AS b, count(*) AS common
            FROM shingles x JOIN shingles y ON x.token = y.token AND x.node < y.node
            GROUP BY x.node, y.node) c
        JOIN set_sizes p ON p.node = c.a JOIN set_sizes q ON q.node = c.b
        WHERE c.common / (p.n + q.n - c.common) >= 0.8""",
    ),
    "both_ways": (("links",), "SELECT a, b FROM links UNION SELECT b, a FROM links"),
    "reach": (
        ("both_ways",),
        """SELECT a AS node, b AS other FROM both_ways UNION
        SELECT r.node, e.b FROM reach r JOIN both_ways e ON r.other = e.a""",
    ),
    "components": (
        ("reach",),
        "SELECT node, least(node, min(other)) AS component FROM reach GROUP BY node",
    ),
    "near_members": (
        ("components", "texts", "idx"),
        """SELECT c.component, i.image_id AS member FROM components c
        JOIN texts t ON t.node = c.node JOIN idx i ON i.md5 = t.content""",
    ),
    "near_groups": (
        ("near_members",),
        """SELECT 'near:' || f.first_member AS group_id, 'near' AS kind, m.member, f.group_size
        FROM near_members m JOIN (SELECT component, count(*) AS group_size,
            min(member) AS first_member FROM near_members GROUP BY component) f
        ON m.component = f.component""",
    ),
    "pred": (
        (),
        """SELECT 'm' || (vec_id % 3) AS model, vec_id AS item, label,
            list_transform(embedding[1:10], lambda x: CAST(x AS DOUBLE)) AS logits
        FROM embeddings""",
    ),
    "scored": (
        ("pred",),
        """SELECT *, CAST(list_position(logits, list_max(logits)) - 1 AS INTEGER) AS pred,
            list_transform(powers, lambda x: x / list_sum(powers)) AS probs
        FROM (SELECT *, list_transform(logits, lambda x: exp(x - list_max(logits))) AS powers
            FROM pred)""",
    ),
    "conf": (
        ("scored",),
        "SELECT model, label, pred, count(*) AS n FROM scored GROUP BY ALL",
    ),
    "marg": (
        ("conf",),
        """SELECT model, cls, CAST(sum(t) AS DOUBLE) AS support, CAST(sum(p) AS DOUBLE) AS predicted,
            CAST(sum(h) AS DOUBLE) AS hits
        FROM (SELECT model, label AS cls, n AS t, 0 AS p, CASE WHEN label = pred THEN n ELSE 0 END AS h
            FROM conf UNION ALL SELECT model, pred, 0, n, 0 FROM conf) GROUP BY model, cls""",
    ),
    "cls": (
        ("marg",),
        """SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted END AS prec,
            CASE WHEN support = 0 THEN 0 ELSE hits / support END AS rec,
            CASE WHEN predicted + support = 0 THEN 0 ELSE 2 * hits / (predicted + support) END AS f1
        FROM marg""",
    ),
    "batches": (
        (),
        """SELECT l_returnflag AS model, l_linenumber AS epoch,
            CASE WHEN l_linestatus = 'O' THEN 'train' ELSE 'val' END AS phase,
            l_discount AS loss, l_quantity AS n, l_quantity * (1 - l_tax) AS correct,
            CAST(l_orderkey AS DOUBLE) AS begin_s, l_orderkey + l_quantity AS end_s
        FROM lineitem""",
    ),
    "tensors": (
        (),
        """SELECT 'net' || (l_suppkey % 7) AS model, l_quantity * 10 * (l_suppkey % 7 + 1) AS numel,
            l_linestatus = 'O' AS trainable FROM lineitem""",
    ),
    "params": (
        ("tensors",),
        """SELECT model, CAST(sum(numel) AS BIGINT) AS total_params,
            CAST(coalesce(sum(CASE WHEN trainable THEN numel END), 0) AS BIGINT) AS trainable_params
        FROM tensors GROUP BY model""",
    ),
    "epochs": (
        (),
        """SELECT event_type AS model,
            CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS INTEGER) AS epoch,
            round(avg(value) / 100, 4) AS acc FROM events GROUP BY 1, 2""",
    ),
    "uev": (
        (),
        """SELECT 'exp' || (user_id % 3) AS experiment, 'run_' || user_id AS run_id, user_id,
            event_id, event_type, epoch_us(ts) // 1000 AS ts, value FROM events""",
    ),
    "meta": (
        ("uev",),
        """SELECT experiment, run_id, 'm' || (user_id % 5) || '_' || run_id AS run_name,
            'FINISHED' AS status, min(ts) AS start_time, 'm' || (user_id % 5) AS model,
            'cleaned_v' || (user_id % 2) AS tag FROM uev GROUP BY experiment, run_id, user_id""",
    ),
    "latest": (
        ("uev",),
        """SELECT run_id, CASE event_type WHEN 'click' THEN 'final_accuracy'
            WHEN 'view' THEN 'latency_mean_ms' WHEN 'purchase' THEN 'cost_per_1k_images_dkk'
            WHEN 'signup' THEN 'maintainability_score' ELSE 'trainable_params' END AS key,
            arg_max(value, event_id) AS value FROM uev GROUP BY 1, 2""",
    ),
    "runs": (
        ("meta", "latest"),
        """SELECT m.run_id, m.experiment, m.run_name, m.status, m.start_time, m.model,
            m.tag AS version_tag, CAST(NULL AS VARCHAR) AS scoring_version,
            pround(max(CASE WHEN key = 'final_accuracy' THEN value END), 4) AS accuracy,
            pround(max(CASE WHEN key = 'latency_mean_ms' THEN value END), 4) AS latency_mean_ms,
            pround(max(CASE WHEN key = 'cost_per_1k_images_dkk' THEN value END), 4)
                AS cost_per_1k_images_dkk,
            pround(max(CASE WHEN key = 'maintainability_score' THEN value END), 4)
                AS maintainability_score,
            CAST(trunc(max(CASE WHEN key = 'trainable_params' THEN value END)) AS BIGINT)
                AS trainable_params
        FROM meta m LEFT JOIN latest v ON m.run_id = v.run_id GROUP BY ALL""",
    ),
    "brand": (
        (),
        """SELECT p_brand, CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INTEGER) AS position,
            round(1 - avg(l_discount), 4) AS accuracy, round(avg(l_quantity), 4) AS latency,
            round(avg(l_extendedprice) / 1000, 4) AS cost, round(avg(p_size) / 10, 4) AS upkeep,
            round(1 - avg(l_tax), 4) AS f1_weighted, round(avg(p_size) / 4, 3) AS param_count
        FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY p_brand""",
    ),
    "cand": (
        ("brand",),
        """SELECT CASE WHEN position % 2 = 0 THEN 'even' ELSE 'odd' END AS comparison_id,
            p_brand AS model, 'cleaned_v1' AS version_tag,
            CASE WHEN position % 7 <> 0 THEN accuracy END AS accuracy,
            CASE WHEN position % 11 = 0 THEN CAST(0 AS DOUBLE) ELSE latency END AS latency_mean_ms,
            cost AS cost_per_1k_images_dkk, upkeep AS maintainability_score, position, f1_weighted,
            pround(1000 / latency, 1) AS throughput_img_per_sec, param_count AS "param_count_M"
        FROM brand""",
    ),
    "norm": (
        ("cand",),
        """SELECT *,
            CASE WHEN accuracy IS NULL THEN 0 WHEN qh = ql THEN 1
                ELSE pround((accuracy - ql) / (qh - ql), 4) END AS quality_score,
            CASE WHEN latency_mean_ms IS NULL THEN 0 WHEN lh = ll THEN 1
                ELSE pround((lh - latency_mean_ms) / (lh - ll), 4) END AS latency_score,
            CASE WHEN cost_per_1k_images_dkk IS NULL THEN 0 WHEN ch = cl THEN 1
                ELSE pround((ch - cost_per_1k_images_dkk) / (ch - cl), 4) END AS cost_score,
            CASE WHEN maintainability_score IS NULL THEN 0 WHEN mh = ml THEN 1
                ELSE pround((maintainability_score - ml) / (mh - ml), 4) END AS upkeep_score
        FROM (SELECT *, min(accuracy) OVER w AS ql, max(accuracy) OVER w AS qh,
            min(latency_mean_ms) OVER w AS ll, max(latency_mean_ms) OVER w AS lh,
            min(cost_per_1k_images_dkk) OVER w AS cl, max(cost_per_1k_images_dkk) OVER w AS ch,
            min(maintainability_score) OVER w AS ml, max(maintainability_score) OVER w AS mh
            FROM cand WINDOW w AS (PARTITION BY comparison_id))""",
    ),
    "ranked": (
        ("norm",),
        """SELECT *, row_number() OVER (PARTITION BY comparison_id ORDER BY overall_score DESC,
            coalesce(accuracy, 0) DESC, coalesce(nullif(latency_mean_ms, 0), 1e9), position)
            AS recommendation_rank
        FROM (SELECT *, pround(quality_score * 0.25 + latency_score * 0.25 + cost_score * 0.25
            + upkeep_score * 0.25, 4) AS overall_score FROM norm)""",
    ),
    "vlog": (
        (),
        """SELECT o_orderpriority || '/' || o_orderstatus AS version_tag,
            CAST(o_orderkey % 1000 AS BIGINT) AS raw_image_count,
            CAST(o_custkey % 1000 AS BIGINT) AS cleaned_image_count,
            CASE WHEN o_custkey % 3 <> 0 THEN md5(CAST(o_orderkey AS VARCHAR)) END AS git_commit,
            strftime(o_orderdate, '%Y-%m-%d') AS created_at,
            CAST(o_custkey AS VARCHAR) AS notes, o_orderkey FROM orders""",
    ),
    "last_per_tag": (
        ("vlog",),
        """SELECT * FROM vlog QUALIFY row_number() OVER (PARTITION BY version_tag
            ORDER BY created_at DESC, o_orderkey DESC) = 1""",
    ),
    "versions": (
        ("last_per_tag",),
        """SELECT CAST(row_number() OVER (ORDER BY created_at, o_orderkey) AS INTEGER) AS version_id,
            version_tag, raw_image_count, cleaned_image_count, git_commit, created_at, notes
        FROM last_per_tag""",
    ),
    "arts": (
        (),
        """SELECT DISTINCT event_type || '_' || (user_id % 5) || CASE WHEN user_id % 4 = 0 THEN ''
            ELSE '_cleaned_v' || (user_id % 3) END || '.pt' AS name FROM events""",
    ),
}


def issues_cte(groups: str | None) -> dict[str, tuple[tuple[str, ...], str]]:
    """Roles `issues`, `assessed`, `resolved` and `validated` over the named group table."""
    return {
        "issues": (
            ("idx", groups),
            f"""SELECT i.*, CASE WHEN quality IS NOT NULL THEN file_size_bytes < 64 END AS corrupt,
                CASE WHEN quality IS NOT NULL THEN toxic = 1 END AS blurry,
                CASE WHEN quality IS NOT NULL THEN quality = 0 END AS dark,
                CASE WHEN quality IS NOT NULL THEN digit_share > 0.02 END AS bright,
                CASE WHEN quality IS NOT NULL THEN height / width < 0.35 END AS lowinfo,
                e.exact_size, e.near_size
            FROM idx i LEFT JOIN (SELECT member,
                max(CASE WHEN kind = 'exact' THEN group_size END) AS exact_size,
                max(CASE WHEN kind = 'near' THEN group_size END) AS near_size
                FROM {groups} GROUP BY member) e ON e.member = i.image_id""",
        ),
        "assessed": (
            ("issues",),
            """SELECT *, 0.0 - (10.0 * is_corrupt + 5.0 * is_blurry + 2.5 * too_dark
                + 2.5 * too_bright + 5.0 * low_information) AS quality_score
            FROM (SELECT *, coalesce(CAST(corrupt AS INTEGER), 0) AS is_corrupt,
                coalesce(CAST(blurry AS INTEGER), 0) AS is_blurry,
                coalesce(CAST(dark AS INTEGER), 0) AS too_dark,
                coalesce(CAST(bright AS INTEGER), 0) AS too_bright,
                coalesce(CAST(lowinfo AS INTEGER), 0) AS low_information,
                CASE WHEN aspect_ratio > 2.5 OR aspect_ratio < 0.4 THEN 1 ELSE 0 END
                    AS odd_aspect_ratio,
                round(1.0 / near_size, 6) AS near_duplicates_score FROM issues)""",
        ),
        "placed": (
            ("assessed", groups),
            f"""SELECT g.group_id, g.kind, a.image_id, a.split, a.class_name,
                a.near_duplicates_score,
                first_value(a.image_id) OVER w AS canonical_image_id,
                first_value(a.split) OVER w AS canonical_split,
                first_value(a.class_name) OVER w AS canonical_class,
                bool_or(a.split = 'train') OVER g AS has_train,
                min(a.split) OVER g = max(a.split) OVER g AS same_split,
                min(a.class_name) OVER g = max(a.class_name) OVER g AS same_class
            FROM {groups} g JOIN assessed a ON g.member = a.image_id
            WINDOW g AS (PARTITION BY g.group_id),
                w AS (PARTITION BY g.group_id ORDER BY CASE WHEN split = 'train' THEN 0 ELSE 1 END,
                    quality_score DESC NULLS LAST, width DESC NULLS LAST, height DESC NULLS LAST,
                    image_id)""",
        ),
        "resolved": (
            ("placed",),
            """SELECT *, image_id <> canonical_image_id AS is_other,
                CASE WHEN image_id <> canonical_image_id THEN canonical_image_id END AS duplicate_of,
                CASE WHEN image_id <> canonical_image_id THEN CAST(CASE WHEN kind = 'near'
                    THEN coalesce(near_duplicates_score, 0) ELSE 0 END AS DOUBLE) END
                    AS duplicate_distance,
                CASE WHEN image_id <> canonical_image_id
                    THEN CAST(split <> canonical_split AS INTEGER) END AS cross_split_duplicate,
                CASE WHEN image_id <> canonical_image_id
                    THEN CAST(class_name <> canonical_class AS INTEGER) END AS cross_class_duplicate,
                CASE WHEN image_id = canonical_image_id THEN NULL
                    WHEN has_train AND split = 'test' THEN 'drop_test_duplicate_train_priority'
                    WHEN same_split AND same_class THEN 'drop_same_split_same_class_lower_quality'
                    WHEN same_split THEN 'keep_cross_class_duplicate_same_split_manual_review'
                    ELSE 'drop_noncanonical_duplicate' END AS drop_reason
            FROM placed""",
        ),
        "settled": (
            ("resolved",),
            """SELECT image_id, arg_max(canonical_image_id, kind || group_id) AS canonical_image_id,
                arg_max(duplicate_of, kind || group_id) FILTER (is_other) AS duplicate_of,
                arg_max(duplicate_distance, kind || group_id) FILTER (is_other)
                    AS duplicate_distance,
                arg_max(cross_split_duplicate, kind || group_id) FILTER (is_other)
                    AS cross_split_duplicate,
                arg_max(cross_class_duplicate, kind || group_id) FILTER (is_other)
                    AS cross_class_duplicate,
                arg_max(drop_reason, kind || group_id) FILTER (is_other) AS drop_reason,
                max(CASE WHEN drop_reason LIKE 'keep%' THEN 1 ELSE 0 END) AS manual_review_required,
                max(CASE WHEN is_other AND kind = 'exact' THEN 1 ELSE 0 END) AS dup_exact,
                max(CASE WHEN is_other AND kind = 'near' THEN 1 ELSE 0 END) AS dup_near
            FROM resolved GROUP BY image_id""",
        ),
        "validated": (
            ("assessed", "settled"),
            """SELECT *, CASE WHEN is_valid = 1 THEN 'data/cleaned/' || split || '/' || class_name
                    || '/' || new_filename END AS cleaned_path
            FROM (SELECT a.*, 0 AS odd_size, s.canonical_image_id, s.duplicate_of,
                s.duplicate_distance, s.drop_reason,
                coalesce(s.cross_split_duplicate, 0) AS cross_split_duplicate,
                coalesce(s.cross_class_duplicate, 0) AS cross_class_duplicate,
                coalesce(s.manual_review_required, 0) AS manual_review_required,
                CASE WHEN exact_size IS NOT NULL OR dup_exact = 1 THEN 1 ELSE 0 END
                    AS is_exact_duplicate,
                CASE WHEN near_size IS NOT NULL OR dup_near = 1 THEN 1 ELSE 0 END
                    AS is_near_duplicate,
                CASE WHEN is_corrupt = 1 OR coalesce(s.drop_reason LIKE 'drop%', FALSE) THEN 0
                    WHEN a.split = 'train' AND (is_blurry = 1 OR too_dark = 1 OR too_bright = 1
                        OR low_information = 1) THEN 0 ELSE 1 END AS is_valid
                FROM assessed a LEFT JOIN settled s ON a.image_id = s.image_id)""",
        ),
    }


def _exact_rounding(sql: str) -> str:
    """Spells out pround(x, n): n digits of the exact value, ties to even."""
    mark = "pround("
    while mark in sql:
        start = sql.rindex(mark)
        depth, comma, place = 1, 0, start + len(mark)
        while depth:
            char = sql[place]
            depth += {"(": 1, ")": -1}.get(char, 0)
            if char == "," and depth == 1:
                comma = place
            place += 1
        value, digits = sql[start + len(mark) : comma], sql[comma + 1 : place - 1].strip()
        spelt = f"CAST(printf('%.{digits}f', CAST({value} AS DOUBLE)) AS DOUBLE)"
        sql = sql[:start] + spelt + sql[place:]
    return sql


def statement(tail: str, *needs: str, groups: str | None = None) -> str:
    """`tail` after a WITH clause holding the needed roles, each after what it is made from."""
    roles = dict(ROLES)
    if groups:
        roles["all_groups"] = (
            ("exact_groups", "near_groups"),
            "SELECT * FROM exact_groups UNION ALL SELECT * FROM near_groups",
        )
        roles.update(issues_cte(groups))
    ordered: list[str] = []

    def add(name: str) -> None:
        if name in ordered:
            return
        for other in roles[name][0]:
            add(other)
        ordered.append(name)

    for name in needs:
        add(name)
    if not ordered:
        return _exact_rounding(tail.strip())
    recursive = "RECURSIVE " if "reach" in ordered else ""
    body = ",\n".join(f"{name} AS ({roles[name][1]})" for name in ordered)
    return _exact_rounding(f"WITH {recursive}{body}\n{tail.strip()}")
