"""The same results as plain SQL over the same tables, written independently of the operators."""

from __future__ import annotations

#: Orders with a known result, and its class.
STATUS = """SELECT o_orderkey AS "ID", CAST(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS INTEGER) AS label
    FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'"""
PLAYER = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")

VIEWS = {
    "home_team": 'SELECT o_orderkey AS "ID", o_totalprice, o_custkey, o_orderpriority FROM orders',
    "away_team": """SELECT o_orderkey AS "ID", c_acctbal, c_nationkey, c_mktsegment
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    **{
        f"{side}_player": f"""SELECT l_orderkey AS "ID",
            CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS l_quantity,
            round(l_extendedprice * 100)::DOUBLE AS l_extendedprice, nullif(round(l_discount * 100), 0)::DOUBLE AS l_discount,
            round(l_tax * 100)::DOUBLE AS l_tax FROM lineitem{where}"""
        for side, where in (("home", " WHERE l_linestatus = 'O'"), ("away", " WHERE l_linestatus = 'F'"), ("all", ""))
    },
    "csv_player": """SELECT l_orderkey AS "ID", CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS l_quantity,
        round(l_extendedprice * 100)::DOUBLE AS l_extendedprice, nullif(round(l_discount * 100), 0)::DOUBLE AS l_discount,
        CASE WHEN l_linenumber <> 7 THEN round(l_tax * 100)::DOUBLE END AS l_tax FROM lineitem""",
    "y": """SELECT "ID", CAST(status = 'F' AS INTEGER) AS "HOME_WINS", CAST(status = 'O' AS INTEGER) AS "DRAW",
        CAST(status = 'P' AS INTEGER) AS "AWAY_WINS" FROM (SELECT o_orderkey AS "ID",
            CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderstatus END AS status FROM orders)""",
    "y_supp": """SELECT l_orderkey AS "ID",
        CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1.0 ELSE -1.0 END) AS DOUBLE) AS "GOAL_DIFF_HOME_AWAY"
        FROM lineitem GROUP BY l_orderkey""",
    "train_ids": """SELECT o_orderkey AS "ID" FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'""",
    "test_ids": """SELECT o_orderkey AS "ID" FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'""",
    "classes": """SELECT "ID", CAST(CASE WHEN "HOME_WINS" = 1 THEN 0 WHEN "DRAW" = 1 THEN 1 WHEN "AWAY_WINS" = 1 THEN 2 END
        AS INTEGER) AS label FROM y""",
    "labelled": "SELECT * FROM classes WHERE label IS NOT NULL",
    "quantities": 'SELECT l_orderkey AS "ID", sum(l_quantity) AS q FROM lineitem GROUP BY l_orderkey',
    "scored": """SELECT "ID", label, q / (q + 52.0::DOUBLE + (100.0::DOUBLE - least(q, 99.0::DOUBLE))) AS p_home,
        52.0::DOUBLE / (q + 52.0::DOUBLE + (100.0::DOUBLE - least(q, 99.0::DOUBLE))) AS p_draw,
        (100.0::DOUBLE - least(q, 99.0::DOUBLE)) / (q + 52.0::DOUBLE + (100.0::DOUBLE - least(q, 99.0::DOUBLE))) AS p_away
        FROM (SELECT l."ID", label, coalesce(q, 0) AS q FROM labelled l LEFT JOIN quantities USING ("ID"))""",
    "predicted": """SELECT *, CASE WHEN p_home >= p_draw AND p_home >= p_away THEN 0
        WHEN p_draw >= p_away THEN 1 ELSE 2 END AS prediction FROM scored""",
    "margins": """SELECT "ID", CASE WHEN "HOME_WINS" = 1 THEN greatest(coalesce("GOAL_DIFF_HOME_AWAY", 0), 0)
        WHEN "AWAY_WINS" = 1 THEN greatest(0.0 - coalesce("GOAL_DIFF_HOME_AWAY", 0), 0) ELSE 0.0 END::DOUBLE AS margin
        FROM y LEFT JOIN y_supp USING ("ID")""",
}

# which earlier view a view reads
NEEDS = {"classes": ["y"], "labelled": ["classes"], "scored": ["labelled", "quantities"], "predicted": ["scored"], "margins": ["y", "y_supp"]}


def rollup_sql(side: str, columns=PLAYER, prefix: str | None = None, moments: str = "sample", count: bool = True) -> str:
    prefix = f"{side}_player_" if prefix is None else prefix
    parts = []
    for c in columns:
        if moments == "sample":
            mean, std = f"avg({c})", f"stddev_samp({c})"
        else:
            mean = f"coalesce(sum({c}), 0) / count(*)"
            std = f"sqrt(greatest(coalesce(sum({c} * {c}), 0) / count(*) - ({mean}) * ({mean}), 0))"
        parts += [
            f'round(coalesce(sum({c}), 0), 4)::DOUBLE AS "{prefix}{c}_sum"',
            f'round({mean}, 4)::DOUBLE AS "{prefix}{c}_mean"',
            f'round({std}, 4)::DOUBLE AS "{prefix}{c}_std"',
        ]
    if count:
        parts.append(f'count(*) AS "{prefix}player_count"')
    return f'SELECT "ID", {", ".join(parts)} FROM {side}_player GROUP BY "ID"'


def exact_rollup_sql(side: str) -> str:
    """The roll-up before rounding, for reports that build on it."""
    return rollup_sql(side).replace("round(", "(").replace(", 4)::DOUBLE", ")::DOUBLE")


MERGED_NUMERIC = (
    ["home_teamo_totalprice", "home_teamo_custkey", "away_teamc_acctbal", "away_teamc_nationkey"]
    + [f"home_player_{c}_{m}" for c in PLAYER for m in ("sum", "mean", "std")] + ["home_player_player_count"]
    + [f"away_player_{c}_{m}" for c in PLAYER for m in ("sum", "mean", "std")] + ["away_player_player_count"]
)
MERGED_TEXT = ["home_teamo_orderpriority", "away_teamc_mktsegment"]


def merged_sql(team_join: str, player_join: str) -> str:
    return f"""SELECT h."ID", h.o_totalprice AS "home_teamo_totalprice", h.o_custkey AS "home_teamo_custkey",
        h.o_orderpriority AS "home_teamo_orderpriority", a.c_acctbal AS "away_teamc_acctbal",
        a.c_nationkey AS "away_teamc_nationkey", a.c_mktsegment AS "away_teamc_mktsegment",
        hp.* EXCLUDE ("ID"), ap.* EXCLUDE ("ID")
        FROM home_team h {team_join} JOIN away_team a ON h."ID" = a."ID"
        {player_join} JOIN home_roll hp ON h."ID" = hp."ID" {player_join} JOIN away_roll ap ON h."ID" = ap."ID" """


SIDES = ["home_team", "away_team", "home_player", "away_player"]


def with_views(body: str, *names: str, **extra: str) -> str:
    """``body`` behind the views it needs, earlier ones first, then the ``extra`` ones."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in wanted:
            wanted.append(name)

    for name in names:
        add(name)
    clauses = [f"{n} AS ({VIEWS[n]})" for n in wanted] + [f"{n} AS ({sql})" for n, sql in extra.items()]
    return f"WITH {', '.join(clauses)} {body}"


def with_merged(body: str, *names: str, rounded: bool = False, team: str = "", player: str = "LEFT", **extra: str) -> str:
    roll = rollup_sql if rounded else exact_rollup_sql
    return with_views(
        body, *SIDES, *names, home_roll=roll("home"), away_roll=roll("away"), merged=merged_sql(team, player), **extra
    )


def per_column(columns, template: str, source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, " + template.format(c=f'"{c}"') + f" FROM {source}" for c in columns)


def split_sql(*cuts: tuple[str, int, int]) -> str:
    cases = " ".join(f"WHEN rn * {den} <= n * {num} THEN '{part}'" for part, num, den in cuts)
    return f"""SELECT "ID", label, CASE WHEN label IS NULL THEN NULL {cases} ELSE 'train' END AS split FROM (
        SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(CAST("ID" AS VARCHAR) || '|42')) AS rn,
        count(*) OVER (PARTITION BY label) AS n FROM classes)"""


HOLDOUT_VALID = (("holdout", 1, 10), ("valid", 3, 10))

FACTORS = (0.9, 1.0, 1.05, 1.1, 1.15, 1.2, 1.3)
FACTOR_ACCURACIES = " UNION ALL ".join(
    f"""SELECT {i} AS position, {a}::DOUBLE AS alpha, round(avg(CASE WHEN label = CASE
        WHEN h >= d AND h >= a THEN 0 WHEN d >= a THEN 1 ELSE 2 END THEN 1.0 ELSE 0.0 END), 8)::DOUBLE AS accuracy
        FROM (SELECT label, {"p_home" if a == 1.0 else f"p_home / (p_home + p_draw * {a}::DOUBLE + p_away)"} AS h,
        {"p_draw" if a == 1.0 else f"p_draw * {a}::DOUBLE / (p_home + p_draw * {a}::DOUBLE + p_away)"} AS d,
        {"p_away" if a == 1.0 else f"p_away / (p_home + p_draw * {a}::DOUBLE + p_away)"} AS a FROM scored)"""
    for i, a in enumerate(FACTORS)
)

DESCRIBE = """SELECT '{name}' AS feature, count({c}) AS n, round(avg({c}), 4)::DOUBLE AS mean,
    round(stddev_samp({c}), 4)::DOUBLE AS std, round(min({c}), 4)::DOUBLE AS min, {percentiles},
    round(max({c}), 4)::DOUBLE AS max FROM {source}"""


def describe_sql(name: str, c: str, source: str) -> str:
    percentiles = ", ".join(
        f"round(quantile_cont({c}, {p}), 4)::DOUBLE AS p{round(p * 100)}" for p in (0.1, 0.25, 0.5, 0.75, 0.9)
    )
    return DESCRIBE.format(name=name, c=c, source=source, percentiles=percentiles)


def histogram_sql(name: str, c: str, source: str) -> str:
    """Counts by comparing with the bin edges, every bin kept."""
    return f"""SELECT '{name}' AS feature, CAST(i + 1 AS INTEGER) AS bin, round(bin_low, 4)::DOUBLE AS bin_low,
        round(bin_high, 4)::DOUBLE AS bin_high, count(v) AS n
        FROM (SELECT i, lo + i * ((hi - lo) / 31) AS bin_low,
            CASE WHEN i = 30 THEN hi ELSE lo + (i + 1) * ((hi - lo) / 31) END AS bin_high
            FROM (SELECT min({c}) AS lo, max({c}) AS hi FROM {source}), range(31) AS r(i)) AS edges
        LEFT JOIN (SELECT {c} AS v FROM {source}) AS vals
            ON v >= bin_low AND (v < bin_high OR i = 30)
        GROUP BY i, bin_low, bin_high"""


REPEATED = """SELECT o_orderkey AS "ID", o_totalprice, o_orderstatus, o_orderpriority FROM orders UNION ALL
    SELECT o_orderkey, o_totalprice + {step}, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus = 'P'"""

EMBEDDED = ", ".join(f"embedding[{i + 1}]::DOUBLE AS e{i}" for i in range(64))
EMBEDDING_NAMES = [f"e{i}" for i in range(64)]


def wide_rollup_sql() -> str:
    parts = ", ".join(
        f'round(coalesce(sum({c}), 0), 4) + 0.0 AS "p_{c}_sum", round(avg({c}), 4) + 0.0 AS "p_{c}_mean", '
        f'round(stddev_samp({c}), 4) + 0.0 AS "p_{c}_std"'
        for c in EMBEDDING_NAMES
    )
    return (
        f'SELECT "ID", {parts}, count(*) AS p_player_count FROM (SELECT label AS "ID", {EMBEDDED} FROM embeddings) '
        'GROUP BY "ID"'
    ).replace("+ 0.0 AS", "+ 0.0::DOUBLE AS")


SELECTABLE_NAMES = [*MERGED_NUMERIC, "price_with_fee", "tax_share"]
SELECTABLE = (
    "SELECT "
    + ", ".join(f'coalesce("{c}", 0)::DOUBLE AS "{c}"' for c in MERGED_NUMERIC)
    + ', (home_teamo_totalprice * 1.08::DOUBLE + home_teamo_custkey)::DOUBLE AS price_with_fee,'
    + " coalesce(home_player_l_tax_mean * 0.001::DOUBLE, 0)::DOUBLE AS tax_share FROM merged"
)


def drop_list_sql() -> str:
    pairs = " UNION ALL ".join(
        f"""SELECT '{b}' AS feature, corr("{a}", "{b}") AS r FROM selectable"""
        for j, b in enumerate(SELECTABLE_NAMES)
        for a in SELECTABLE_NAMES[:j]
    )
    return with_merged(
        f"SELECT DISTINCT feature FROM ({pairs}) WHERE NOT isnan(r) AND abs(r) > 0.995", selectable=SELECTABLE
    )


CORR = """CASE WHEN isnan({r}) THEN NULL ELSE round(abs({r}), 6) + 0.0 END::DOUBLE"""


def target_corr_sql() -> str:
    rows = " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, '{t}' AS target, corr("{c}", "{t}") AS r FROM xy"""
        for c in MERGED_NUMERIC
        for t in ("HOME_WINS", "DRAW", "AWAY_WINS")
    )
    return with_merged(
        f"""SELECT feature, target, {CORR.format(r="r")} AS abs_corr, CAST(rank AS INTEGER) AS rank FROM (
            SELECT *, row_number() OVER (PARTITION BY target ORDER BY abs(nullif(r, 'nan'::DOUBLE)) DESC NULLS LAST, feature) AS rank
            FROM ({rows})) WHERE rank <= 10""",
        "y",
        xy='SELECT * FROM merged LEFT JOIN y USING ("ID")',
    )


def stacked_sql(side: str) -> str:
    return f"""SELECT h."ID", o_totalprice, o_custkey, o_orderpriority, c_acctbal, c_nationkey, c_mktsegment, l_quantity,
        l_extendedprice, l_discount, l_tax, '{side}' AS side FROM home_team h JOIN away_team a ON h."ID" = a."ID"
        LEFT JOIN {side}_player p ON h."ID" = p."ID" """


# Places of a rotation: a bucket by the id, and the next value in it by a seeded order.
BUCKET = "CAST('0x' || substr(md5(CAST({id} AS VARCHAR)), 1, 8) AS BIGINT) % 256"
ROTATED = """SELECT *, CAST({repeat} AS INTEGER) AS repeat, coalesce(lead({a}) OVER w, first_value({a}) OVER w) AS next_a,
    coalesce(lead({b}) OVER w, first_value({b}) OVER w) AS next_b FROM rows
    WINDOW w AS (PARTITION BY bucket ORDER BY md5(CAST("ID" AS VARCHAR) || '|{seed}'))"""

YEARS = range(1995, 2002)
MODEL_FEATURES = [
    *MERGED_NUMERIC,
    *[f"home_teamo_orderpriority_{level}" for level in ("2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")],
    *[f"away_teamc_mktsegment_{level}" for level in ("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")],
]

ORACLE: dict[str, str] = {
    "merged_table": with_merged("SELECT * FROM merged", rounded=True, player=""),
    "merged_table_lenient": with_merged("SELECT * FROM merged", rounded=True, team="LEFT"),
    "merged_table_mixed": with_merged("SELECT * FROM merged", rounded=True),
    "player_rollup_sample": with_views(rollup_sql("all", prefix="player_"), "all_player"),
    "player_rollup_chunked": with_views(rollup_sql("all", prefix="player_"), "all_player"),
    "player_rollup_rowcount_pop": with_views(rollup_sql("all", prefix="player_", moments="population_rows"), "all_player"),
    "player_rollup_notebook": with_views(rollup_sql("all", prefix="player_", count=False), "all_player"),
    "wide_player_rollup": wide_rollup_sql(),
    "streaming_wide_rollup": wide_rollup_sql(),
    "raw_player_rows": with_views(f"{stacked_sql('home')} UNION ALL {stacked_sql('away')}", *SIDES),
    "raw_player_fanout": with_views(
        """SELECT "ID", coalesce(hn, 0) AS home_rows, coalesce(an, 0) AS away_rows,
            greatest(coalesce(hn, 0), 1) * greatest(coalesce(an, 0), 1) AS paired_rows FROM home_team
            LEFT JOIN (SELECT "ID", count(*) AS hn FROM home_player GROUP BY 1) USING ("ID")
            LEFT JOIN (SELECT "ID", count(*) AS an FROM away_player GROUP BY 1) USING ("ID")""",
        *SIDES,
    ),
    "validated_one_to_one": with_views('SELECT * FROM home_team JOIN away_team USING ("ID")', *SIDES),
    "align_labels": with_views('SELECT * FROM train_ids LEFT JOIN y USING ("ID") ORDER BY "ID"', "train_ids", "y"),
    "align_labels_missing": with_views(
        """SELECT count(*) FILTER (WHERE "HOME_WINS" IS NULL OR "DRAW" IS NULL OR "AWAY_WINS" IS NULL) AS missing_labels,
            count(*) AS n_rows FROM train_ids LEFT JOIN y USING ("ID")""",
        "train_ids", "y",
    ),
    "align_labels_supp": with_views(
        'SELECT * FROM train_ids LEFT JOIN y_supp USING ("ID") ORDER BY "ID"', "train_ids", "y_supp"
    ),
    "label_semi": with_views(
        """SELECT "ID" AS id, "HOME_WINS" AS home, "DRAW" AS draw, "AWAY_WINS" AS away FROM y
            WHERE "ID" IN (SELECT "ID" FROM train_ids)""",
        "train_ids", "y",
    ),
    "xy_left": with_views(
        'SELECT * FROM home_team LEFT JOIN y USING ("ID") LEFT JOIN y_supp USING ("ID")', "home_team", "y", "y_supp"
    ),
    "xy_feature_left": with_views(
        'SELECT "ID", "HOME_WINS", "DRAW", "AWAY_WINS", '
        + ", ".join(f"coalesce({c}_{m}, 0)::DOUBLE AS {c}_{m}" for c in PLAYER for m in ("sum", "mean", "std"))
        + ', coalesce(player_count, 0) AS player_count FROM y LEFT JOIN rolled USING ("ID")',
        "y", "all_player", rolled=rollup_sql("all", prefix=""),
    ),
    "dedup_exact": f"SELECT DISTINCT * FROM ({REPEATED.format(step='0.0')})",
    "dedup_first_by_id": f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY "ID" ORDER BY o_totalprice) AS rn
        FROM ({REPEATED.format(step='1.0')})) WHERE rn = 1""",
    "dedup_removed": f"""WITH r AS ({REPEATED.format(step='0.0')} UNION ALL {REPEATED.format(step='1.0')}),
        d AS (SELECT DISTINCT * FROM r)
        SELECT (SELECT count(*) FROM r) AS rows_before,
            (SELECT count(*) FROM r) - (SELECT count(*) FROM d) AS exact_duplicates,
            (SELECT count(*) FROM d) - (SELECT count(DISTINCT "ID") FROM d) AS repeated_keys,
            (SELECT count(DISTINCT "ID") FROM d) AS rows_after""",
    "id_uniqueness": with_views(
        " UNION ALL ".join(
            f"""SELECT '{t}' AS dataset, count(*) AS n_rows, count(DISTINCT "ID") AS distinct_ids,
                count(*) = count(DISTINCT "ID") AS is_unique FROM {t}"""
            for t in SIDES
        ),
        *SIDES,
    ),
    "id_overlap": with_views(
        """SELECT count(*) AS shared_ids FROM (SELECT "ID" FROM train_ids INTERSECT
            SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01')""",
        "train_ids",
    ),
    "class_distribution": with_views(
        """SELECT class_name, n, round(n / sum(n) OVER (), 6)::DOUBLE AS ratio FROM (
            SELECT 'HOME_WINS' AS class_name, CAST(sum("HOME_WINS") AS BIGINT) AS n FROM y UNION ALL
            SELECT 'DRAW', CAST(sum("DRAW") AS BIGINT) FROM y UNION ALL
            SELECT 'AWAY_WINS', CAST(sum("AWAY_WINS") AS BIGINT) FROM y) ORDER BY n DESC, class_name""",
        "y",
    ),
    "majority_baseline": with_views(
        """SELECT round(greatest(sum("HOME_WINS"), sum("DRAW"), sum("AWAY_WINS"))
            / (sum("HOME_WINS") + sum("DRAW") + sum("AWAY_WINS")), 6)::DOUBLE AS baseline_accuracy FROM y""",
        "y",
    ),
    "describe_percentiles": with_views(
        describe_sql("goal_diff", '"GOAL_DIFF_HOME_AWAY"', "y_supp")
        + " UNION ALL "
        + describe_sql("o_totalprice", "o_totalprice", "orders"),
        "y_supp",
    ),
    "histogram31": with_views(
        histogram_sql("goal_diff", '"GOAL_DIFF_HOME_AWAY"', "y_supp")
        + " UNION ALL "
        + histogram_sql("o_totalprice", "o_totalprice", "orders"),
        "y_supp",
    ),
    "missing_ratio_top30": with_merged(
        "SELECT feature, round(r, 6)::DOUBLE AS missing_ratio FROM ("
        + per_column(MERGED_NUMERIC + MERGED_TEXT, "count(*) FILTER (WHERE {c} IS NULL) / count(*)::DOUBLE AS r", "merged")
        + ") WHERE r > 0 ORDER BY r DESC, feature LIMIT 30"
    ),
    "feature_overview": with_merged(
        " UNION ALL ".join(
            f"""SELECT '{part}' AS dataset, count(*) AS n_features, {len(MERGED_NUMERIC)}::BIGINT AS n_numeric,
            {len(MERGED_TEXT)}::BIGINT AS n_other, count(*) FILTER (WHERE n > 0) AS with_missing FROM ("""
            + per_column(
                MERGED_NUMERIC + MERGED_TEXT, "count(*) FILTER (WHERE {c} IS NULL) AS n",
                f'(SELECT * FROM merged WHERE "ID" IN (SELECT "ID" FROM {part}_ids))',
            )
            + ")"
            for part in ("train", "test")
        ),
        "train_ids", "test_ids",
    ),
    "variance_top_bottom": with_merged(
        """SELECT feature, CASE WHEN v > 1e6 THEN round(v, -4) ELSE round(v, 2) END::DOUBLE AS variance, 'top' AS part FROM
            (SELECT * FROM measured ORDER BY v DESC NULLS LAST, feature LIMIT 15) UNION ALL
            SELECT feature, CASE WHEN v > 1e6 THEN round(v, -4) ELSE round(v, 2) END::DOUBLE, 'bottom' FROM
            (SELECT * FROM measured ORDER BY v ASC NULLS FIRST, feature DESC LIMIT 15)""",
        measured=per_column(MERGED_NUMERIC, "var_samp({c}) AS v", "merged"),
    ),
    "corr_targets_topk": target_corr_sql(),
    "shape_summary": with_merged(
        f"""SELECT part || '_merged' AS dataset, count(*) AS n_rows, {len(MERGED_NUMERIC + MERGED_TEXT) + 1}::BIGINT AS n_cols
            FROM (SELECT CASE WHEN "ID" IN (SELECT "ID" FROM train_ids) THEN 'train' ELSE 'test' END AS part FROM merged)
            GROUP BY part UNION ALL
            SELECT 'y_train_aligned', count(*), 4 FROM train_ids LEFT JOIN y USING ("ID") UNION ALL
            SELECT 'y_train_supp_aligned', count(*), 2 FROM train_ids LEFT JOIN y_supp USING ("ID")""",
        "train_ids", "y", "y_supp",
    ),
    "constant_columns": "SELECT feature, known + CAST(gaps > 0 AS INTEGER) <= 1 AS is_constant FROM ("
    + per_column(
        ["l_quantity", "l_linestatus", "l_returnflag", "currency", "taxed", "large", "never"],
        "count(DISTINCT {c}) AS known, count(*) FILTER (WHERE {c} IS NULL) AS gaps",
        """(SELECT l_quantity, l_linestatus, l_returnflag, 'EUR' AS currency, CASE WHEN l_tax >= 0 THEN 1 END AS taxed,
            CASE WHEN l_quantity > 25 THEN 1 END AS large, CASE WHEN l_quantity < 0 THEN 1 END AS never
            FROM lineitem)""",
    )
    + ")",
    "distinct_counts": per_column(["o_custkey", "o_orderpriority", "o_totalprice"], "count(DISTINCT {c}) AS n_distinct", "orders"),
    "corr_matrix_upper": f"""WITH cells AS (SELECT vec_id, unnest(range(64)) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings)
        SELECT 'e' || a.i AS left_feature, 'e' || b.i AS right_feature, round(abs(corr(a.x, b.x)), 5) AS abs_corr
        FROM cells a JOIN cells b ON a.vec_id = b.vec_id AND a.i < b.i GROUP BY a.i, b.i""",
    "corr_drop_list": drop_list_sql(),
    "variance_select": with_merged(
        "SELECT CAST(row_number() OVER (ORDER BY place) - 1 AS INTEGER) AS position, feature FROM ("
        + " UNION ALL ".join(
            f"""SELECT {i} AS place, '{c}' AS feature, var_pop("{c}") AS v FROM selectable"""
            for i, c in enumerate(SELECTABLE_NAMES)
        )
        + ") WHERE v > 0.0001",
        selectable=SELECTABLE,
    ),
    "onehot_to_class": with_views(
        """SELECT o_orderkey AS "ID", CAST(label AS INTEGER) AS label, CAST(coalesce(label, 0) AS INTEGER) AS label_home_default
            FROM orders LEFT JOIN labelled ON o_orderkey = "ID" """,
        "labelled",
    ),
    "win_margin": with_views("SELECT * FROM margins", "margins"),
    "margin_weights": with_views(
        """SELECT "ID", margin, 1.0::DOUBLE AS weight_none, round(1.0 + 0.25 * margin, 4)::DOUBLE AS weight_linear,
            round(least(exp(0.2 * margin), 5.0), 4)::DOUBLE AS weight_exp FROM margins""",
        "margins",
    ),
    "weight_stats": with_views(
        " UNION ALL ".join(
            f"""SELECT '{name}' AS run_name, round(min(w), 4)::DOUBLE AS min_weight, round(median(w), 4)::DOUBLE AS median_weight,
                round(max(w), 4)::DOUBLE AS max_weight FROM (SELECT {w} AS w FROM margins)"""
            for name, w in (("linear_small", "1.0 + 0.25 * margin"), ("exp_soft", "least(exp(0.2 * margin), 5.0)"))
        ),
        "margins",
    ),
    "balanced_weights": with_views(
        """SELECT "ID", CAST(label AS INTEGER) AS label, round((SELECT count(*) FROM labelled)
            / ((SELECT count(DISTINCT label) FROM labelled) * count(*) OVER (PARTITION BY label))::DOUBLE, 8)::DOUBLE AS weight
            FROM labelled""",
        "labelled",
    ),
    "numeric_coerce": """SELECT o_orderkey AS "ID", o_totalprice, CAST(o_custkey AS DOUBLE) AS customer_text,
        CAST(NULL AS DOUBLE) AS o_orderpriority, CAST(left(o_orderpriority, 1) AS DOUBLE) AS priority_text,
        CAST(NULL AS DOUBLE) AS o_orderdate, CAST(o_totalprice > 250000 AS DOUBLE) AS large FROM orders""",
    "clean_features": with_merged(
        """SELECT "ID", CASE WHEN away_teamc_acctbal > 9000 OR away_teamc_acctbal < 0 THEN 0.0 ELSE away_teamc_acctbal END::FLOAT AS odd, """
        + ", ".join(f'coalesce("{c}", 0)::FLOAT AS "{c}"' for c in MERGED_NUMERIC)
        + " FROM merged"
    ),
    "encode_categoricals": """SELECT o_orderkey AS "ID", o_totalprice, CAST(o_totalprice > 250000 AS TINYINT) AS large, """
    + ", ".join(
        f"""CAST(c_mktsegment = '{level}' AS TINYINT) AS "c_mktsegment_{level}" """
        for level in ("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
    )
    + ", "
    + ", ".join(
        f"""CAST(o_orderpriority = '{level}' AS TINYINT) AS "o_orderpriority_{level}" """
        for level in ("2-HIGH", "3-MEDIUM", "5-LOW")
    )
    + """, CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 'train' ELSE 'test' END AS part
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "score_mixed_types": """SELECT o_orderkey AS "ID", """
    + ", ".join(f'CAST(year(o_orderdate) = {y} AS TINYINT) AS "year_{y}"' for y in YEARS[1:])
    + "".join(f', CAST(0 AS TINYINT) AS "year_Y{y}"' for y in YEARS)
    + """, CAST(0 AS TINYINT) AS "large_O", CAST(0 AS TINYINT) AS "large_P",
        CAST(NOT o_totalprice > 250000 AS TINYINT) AS large_false, CAST(o_totalprice > 250000 AS TINYINT) AS large_true,
        CAST(0 AS TINYINT) AS priority_2, CAST(left(o_orderpriority, 1) = '2' AS TINYINT) AS "priority_2.0",
        CAST(0 AS TINYINT) AS priority_3, CAST(0 AS TINYINT) AS priority_4, CAST(0 AS TINYINT) AS priority_5 FROM orders""",
    "align_features": with_views(
        """SELECT "ID", c_acctbal, 0.0::DOUBLE AS not_in_test, o_totalprice FROM home_team JOIN away_team USING ("ID")""",
        "home_team", "away_team",
    ),
    "common_columns": with_views(
        """SELECT "ID", l_discount, l_extendedprice, l_quantity FROM home_player UNION ALL
            SELECT "ID", l_discount, l_extendedprice, l_quantity FROM away_player""",
        "home_player", "away_player",
    ),
    "stratified_split_70_20_10": with_views(split_sql(*HOLDOUT_VALID), "classes"),
    "stratified_split_64_16_20": with_views(split_sql(("valid", 20, 100), ("holdout", 36, 100)), "classes"),
    "stratified_split_80_20": with_views(split_sql(("valid", 1, 5)), "classes"),
    "draw_alpha": with_views(
        """SELECT "ID", CAST(label AS INTEGER) AS label, round(p_home / (p_home + p_draw * 1.2::DOUBLE + p_away), 8) AS p_home,
            round(p_draw * 1.2::DOUBLE / (p_home + p_draw * 1.2::DOUBLE + p_away), 8) AS p_draw,
            round(p_away / (p_home + p_draw * 1.2::DOUBLE + p_away), 8) AS p_away FROM scored""",
        "scored",
    ),
    "tune_draw_alpha": with_views(
        f"SELECT alpha, accuracy FROM ({FACTOR_ACCURACIES}) ORDER BY accuracy DESC, position LIMIT 1", "scored"
    ),
    "draw_alpha_accuracies": with_views(FACTOR_ACCURACIES, "scored"),
    "accuracy": with_views(
        "SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 8)::DOUBLE AS accuracy FROM predicted", "predicted"
    ),
    "confusion_matrix": with_views(
        """SELECT CAST(c AS INTEGER) AS label, count(*) FILTER (WHERE prediction = 0) AS predicted_0,
            count(*) FILTER (WHERE prediction = 1) AS predicted_1, count(*) FILTER (WHERE prediction = 2) AS predicted_2
            FROM range(3) AS r(c) LEFT JOIN predicted ON label = c GROUP BY c""",
        "predicted",
    ),
    "classification_report": with_views(
        """SELECT class_name, round(precision, 8)::DOUBLE AS precision, round(recall, 8)::DOUBLE AS recall,
            round(f1, 8)::DOUBLE AS f1, CAST(support AS BIGINT) AS support FROM (
            SELECT class_name, precision, recall, f1, support FROM per_class UNION ALL
            SELECT 'accuracy', a, a, a, n FROM overall UNION ALL
            SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM per_class UNION ALL
            SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                sum(f1 * support) / sum(support), sum(support) FROM per_class)""",
        "predicted",
        overall="SELECT avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS a, count(*) AS n FROM predicted",
        counts="""SELECT c, ['HOME_WINS', 'DRAW', 'AWAY_WINS'][c + 1] AS class_name,
            count(*) FILTER (WHERE label = c AND prediction = c) AS hits, count(*) FILTER (WHERE prediction = c) AS guessed,
            count(*) FILTER (WHERE label = c) AS support FROM range(3) AS r(c), predicted GROUP BY c""",
        rates="""SELECT class_name, support, coalesce(hits / nullif(guessed, 0)::DOUBLE, 0) AS precision,
            coalesce(hits / nullif(support, 0)::DOUBLE, 0) AS recall FROM counts""",
        per_class="""SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM rates""",
    ),
    "submission_onehot": with_views(
        """SELECT "ID", CAST(prediction = 0 AS TINYINT) AS "HOME_WINS", CAST(prediction = 1 AS TINYINT) AS "DRAW",
            CAST(prediction = 2 AS TINYINT) AS "AWAY_WINS" FROM predicted""",
        "predicted",
    ),
    "submission_proba": with_views(
        """SELECT "ID", round(p_away, 8) AS "AWAY", round(p_draw, 8) AS "DRAW", round(p_home, 8) AS "HOME" FROM scored""",
        "scored",
    ),
    "streaming_rollup": with_views(rollup_sql("all", prefix="player_"), "all_player"),
    "bucketed_tables": with_merged(
        """SELECT m.*, "HOME_WINS", "DRAW", "AWAY_WINS", "GOAL_DIFF_HOME_AWAY" FROM merged m LEFT JOIN y USING ("ID")
            LEFT JOIN y_supp USING ("ID")""",
        "y", "y_supp", rounded=True,
    ),
    "streaming_tiers": with_views(rollup_sql("all", prefix="player_", moments="population_rows"), "all_player"),
    "csv_stream_rollup": with_views(rollup_sql("csv", prefix="player_"), "csv_player"),
    "csv_stream_misfits": """SELECT unnest(['ID', '_rows', 'l_discount', 'l_extendedprice', 'l_quantity', 'l_tax']) AS feature,
        unnest([0, count(*), 0, 0, 0, count(*) FILTER (l_linenumber = 7)]) AS n_misfits FROM lineitem""",
    "streaming_state_merge": with_views(rollup_sql("all", prefix="player_", moments="population_rows"), "all_player"),
    "csv_round_trip": """SELECT l_orderkey AS "ID", l_quantity, CASE WHEN l_returnflag = 'R' THEN 'say ""hi"", "' || l_linestatus || '" ok'
        WHEN l_returnflag = 'A' THEN ' two' || chr(10) || 'lines, ' || l_linenumber || ' " ' END AS note,
        round(l_tax * 100)::DOUBLE AS l_tax, round(l_tax * 100)::DOUBLE AS tax FROM lineitem""",
    "csv_late_types": """SELECT o_orderkey AS "ID", CASE WHEN o_orderkey > (SELECT avg(o_orderkey) FROM orders) THEN o_totalprice
        ELSE floor(o_totalprice) END AS price FROM orders""",
    "goal_csv": with_views("SELECT * FROM y_supp", "y_supp"),
    "merge_from_csv": with_merged(
        """SELECT m.* REPLACE (m."away_teamc_nationkey"::BIGINT AS "away_teamc_nationkey"),
            "HOME_WINS"::BIGINT AS "HOME_WINS", "DRAW"::BIGINT AS "DRAW", "AWAY_WINS"::BIGINT AS "AWAY_WINS", "GOAL_DIFF_HOME_AWAY",
            CASE WHEN t."ID" IS NULL THEN 'test' ELSE 'train' END AS part
            FROM merged m LEFT JOIN train_ids t ON m."ID" = t."ID" LEFT JOIN y ON t."ID" = y."ID" LEFT JOIN y_supp s ON t."ID" = s."ID" """,
        "train_ids", "y", "y_supp", rounded=True, player="",
    ),
    "label_csv": with_views(
        """SELECT "ID", "HOME_WINS"::BIGINT AS "HOME_WINS", "DRAW"::BIGINT AS "DRAW", "AWAY_WINS"::BIGINT AS "AWAY_WINS" FROM y""",
        "y",
    ),
    "merged_written": with_merged(
        """SELECT m.*, CASE WHEN m."ID" IN (SELECT "ID" FROM train_ids) THEN 'train' ELSE 'test' END AS part FROM merged m""",
        "train_ids",
        rounded=True,
        player="",
    ),
    "exploratory_merge": with_views(
        """SELECT h."ID" AS match_id, o_totalprice AS home_team_o_totalprice, o_custkey AS home_team_o_custkey,
            c_acctbal AS away_team_c_acctbal, c_nationkey AS away_team_c_nationkey, hp.* EXCLUDE ("ID"), ap.* EXCLUDE ("ID"),
            CASE WHEN t."ID" IS NOT NULL THEN "HOME_WINS" END AS home, CASE WHEN t."ID" IS NOT NULL THEN "DRAW" END AS draw,
            CASE WHEN t."ID" IS NOT NULL THEN "AWAY_WINS" END AS away, CASE WHEN t."ID" IS NULL THEN 'test' ELSE 'train' END AS part
            FROM home_team h JOIN away_team a USING ("ID") LEFT JOIN home_roll hp USING ("ID") LEFT JOIN away_roll ap USING ("ID")
            LEFT JOIN train_ids t USING ("ID") LEFT JOIN y USING ("ID")""",
        *SIDES, "train_ids", "y",
        home_roll=rollup_sql("home", count=False), away_roll=rollup_sql("away", count=False),
    ),
    "file_discovery": "SELECT l_linestatus, count(*) AS n_rows FROM lineitem GROUP BY l_linestatus",
    "schema_summary": with_views(
        f"""SELECT CASE WHEN "ID" IN (SELECT "ID" FROM train_ids) THEN 'train' ELSE 'test' END AS dataset, count(*) AS n_rows,
            {len(MERGED_NUMERIC + MERGED_TEXT) + 1}::BIGINT AS n_cols, 'ID,home_teamo_totalprice,home_teamo_custkey,'
            || 'home_teamo_orderpriority,away_teamc_acctbal,away_teamc_nationkey,away_teamc_mktsegment,home_player_l_quantity_sum,'
            || 'home_player_l_quantity_mean,home_player_l_quantity_std' AS columns_sample
            FROM home_team JOIN away_team USING ("ID") GROUP BY 1""",
        "home_team", "away_team", "train_ids",
    ),
    "stratified_folds_3": with_views(
        """SELECT "ID", label, CASE WHEN label IS NULL THEN NULL WHEN rn * 3 <= n THEN '0' WHEN rn * 3 <= 2 * n THEN '1' ELSE '2' END AS fold
            FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(CAST("ID" AS VARCHAR) || '|42')) AS rn,
            count(*) OVER (PARTITION BY label) AS n FROM classes)""",
        "classes",
    ),
    "feature_shuffle": f"""WITH rows AS (SELECT o_orderkey AS "ID", o_totalprice, o_custkey, {BUCKET.format(id="o_orderkey")} AS bucket FROM orders),
        rotated AS ({" UNION ALL ".join(ROTATED.format(repeat=r, seed=s, a="o_totalprice", b="o_custkey") for r, s in enumerate((42, 43)))})
        SELECT "ID", CASE WHEN shuffled = 'o_totalprice' THEN next_a ELSE o_totalprice END AS o_totalprice,
            CASE WHEN shuffled = 'o_custkey' THEN next_b ELSE o_custkey END AS o_custkey, repeat, shuffled
        FROM rotated, (VALUES ('o_totalprice'), ('o_custkey')) AS f(shuffled)""",
    "permutation_of_rule": with_views(
        """SELECT feature, round(avg(base - a), 8)::DOUBLE AS importance, round(stddev_pop(base - a), 8)::DOUBLE AS spread FROM (
            SELECT feature, repeat, avg(CASE WHEN label = CASE WHEN v > 60 THEN 0 WHEN v > 20 THEN 1 ELSE 2 END THEN 1.0::DOUBLE ELSE 0.0 END) AS a
            FROM (SELECT label, repeat, unnest(['q', 'o_totalprice']) AS feature, unnest([next_a, q]) AS v FROM rotated) GROUP BY feature, repeat),
            (SELECT avg(CASE WHEN label = CASE WHEN q > 60 THEN 0 WHEN q > 20 THEN 1 ELSE 2 END THEN 1.0::DOUBLE ELSE 0.0 END) AS base FROM rows)
            GROUP BY feature""",
        "labelled", "all_player",
        rows=f"""SELECT l."ID", label, coalesce(q, 0) AS q, {BUCKET.format(id='l."ID"')} AS bucket FROM labelled l
            LEFT JOIN (SELECT "ID", sum(l_quantity) AS q FROM all_player GROUP BY "ID") USING ("ID")""",
        rotated=" UNION ALL ".join(ROTATED.format(repeat=r, seed=s, a="q", b="q") for r, s in enumerate((42, 43))),
    ),
    "run_report_totals": with_views(
        f"""SELECT class_name, CAST(support AS BIGINT) AS support, n AS n_rows, CAST({len(MODEL_FEATURES)} AS INTEGER) AS n_features
            FROM (SELECT count(*) AS n FROM labelled), LATERAL (
                SELECT ['HOME_WINS', 'DRAW', 'AWAY_WINS'][label + 1] AS class_name, count(*) AS support FROM labelled GROUP BY label
                UNION ALL SELECT unnest(['accuracy', 'macro avg', 'weighted avg']), n)""",
        "labelled",
    ),
    "rf_importance_totals": "SELECT CAST(i AS INTEGER) AS position, feature, 1.0::DOUBLE AS total, true AS is_share FROM (VALUES "
    + ", ".join(f"({i}, '{c}')" for i, c in enumerate(MODEL_FEATURES))
    + ") AS f(i, feature)",
    "gbt_ovr_sizes": with_views(
        f"SELECT split, count(*) AS n_rows, true AS has_accuracy FROM ({split_sql(*HOLDOUT_VALID)}) WHERE label IS NOT NULL GROUP BY split",
        "classes",
    ),
    "batch_score_totals": with_merged(
        """SELECT count(*) AS n_rows, count(DISTINCT "ID") AS n_ids, CAST(0 AS BIGINT) AS bad_sums FROM merged
            WHERE "ID" NOT IN (SELECT "ID" FROM train_ids)""",
        "train_ids",
    ),
    "forest_of_status": f"""SELECT "ID", label, label AS prediction, {', '.join(
            f"CAST(label = {k} AS DOUBLE) AS {c}" for k, c in enumerate(('p_home', 'p_draw', 'p_away')))} FROM ({STATUS})""",
    "forest_of_status_importance": """SELECT * FROM (VALUES ('status_code', 1.0::DOUBLE), ('o_totalprice', 0.0::DOUBLE),
            ('o_custkey', 0.0::DOUBLE)) AS f(feature, importance)""",
    "gbt_of_status": f'SELECT "ID", label, label AS prediction FROM ({STATUS})',
    "grid_of_status": """SELECT '{''n_trees'': ' || n || ', ''max_depth'': ' || d || ', ''min_split'': ' || s || '}' AS params,
            1.0::DOUBLE AS cv_accuracy
        FROM (VALUES (1), (3)) AS t(n), (VALUES ('2'), ('None')) AS u(d), (VALUES (2), (10)) AS v(s)""",
}
