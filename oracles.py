"""Reference SQL for the catalogue: the same results, computed by DuckDB.

Every text stands on the common table expressions below, which derive teams,
matches and balls from the star-schema tables and then build the feature table.
"""

from __future__ import annotations

from itertools import combinations

# Feature names, in output order.
FEATURES = [
    "Batting_Index",
    "Net_Run_Rate",
    "Fours",
    "Six",
    "matchplayed",
    "Centuries",
    "Fifties",
    "Bowling_Index",
    "Extras",
    "Bo_Econ",
    "Avg_Toss_Won",
    "AVG_Bat_Won",
    "AVG_Wins",
]
KEYS = ["id", "season", "Home_team", "Away_team"]
ALL_18 = [*KEYS, "Home_team_Win", *FEATURES]
PREDICTORS_17 = [*KEYS, *FEATURES]
MODEL_16 = [c for c in PREDICTORS_17 if c != "id"]
PAIRS = list(combinations(FEATURES, 2))


def r6(expression: str) -> str:
    """Six decimals, halves up; within a millionth below counts as half."""
    return f"floor(({expression}) * 1e6::DOUBLE + 0.500001::DOUBLE) / 1e6::DOUBLE"


def r6_as(columns: str) -> str:
    """Rounded columns under their own names, from a blank-separated list."""
    return ", ".join(f"{r6(c)} AS {c}" for c in columns.split())


SOURCES = """
teams AS (
  SELECT n_nationkey + 1 AS team_id, n_name AS Team_name,
         'C' || n_nationkey AS ground_a, 'C' || (25 + n_regionkey) AS ground_b
  FROM nation),
matches AS (
  SELECT o.o_orderkey AS id, year(o.o_orderdate)::INTEGER AS season,
         'C' || (o.o_orderkey % 30) AS city, o.o_orderdate::DATE AS date,
         a.n_name AS team1, b.n_name AS team2,
         CASE WHEN o.o_custkey % 2 = 0 THEN a.n_name ELSE b.n_name END AS toss_winner,
         CASE WHEN left(o.o_orderpriority, 1) IN ('1', '2') THEN 'bat' ELSE 'field' END AS toss_decision,
         CASE o.o_orderstatus WHEN 'F' THEN a.n_name WHEN 'O' THEN b.n_name END AS winner
  FROM orders o
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation a ON a.n_nationkey = c.c_nationkey
  JOIN nation b ON b.n_nationkey = (c.c_nationkey + 1 + o.o_orderkey % 24) % 25),
raw_balls AS (
  SELECT l_orderkey AS match_id, CASE WHEN l_linenumber % 2 = 1 THEN 1 ELSE 2 END AS inning,
         l_linenumber AS over_no, 'P' || (l_partkey % 2) AS batsman,
         l_quantity::INTEGER - 1 AS off_bat, round(l_tax * 100)::INTEGER AS kind, l_returnflag
  FROM lineitem),
deliveries AS (
  SELECT r.match_id, r.inning, r.over_no, r.batsman, r.off_bat, r.kind,
         CASE WHEN r.kind BETWEEN 0 AND 3 THEN 1 WHEN r.kind = 4 THEN 5 ELSE 0 END AS extra,
         CASE WHEN r.l_returnflag = 'R' THEN r.batsman ELSE '' END AS dismissed,
         CASE WHEN r.inning = 1 THEN m.team1 ELSE m.team2 END AS batting_team,
         CASE WHEN r.inning = 1 THEN m.team2 ELSE m.team1 END AS bowling_team
  FROM raw_balls r JOIN matches m ON m.id = r.match_id)"""

GAMES = """
sided AS (
  SELECT m.*, coalesce(m.city IN (b.ground_a, b.ground_b), FALSE)
              AND NOT coalesce(m.city IN (a.ground_a, a.ground_b), FALSE) AS away_first
  FROM matches m JOIN teams a ON a.Team_name = m.team1 JOIN teams b ON b.Team_name = m.team2),
placed AS (
  SELECT *, CASE WHEN away_first THEN team2 ELSE team1 END AS Home_team,
            CASE WHEN away_first THEN team1 ELSE team2 END AS Away_team
  FROM sided),
game_stats AS (
  SELECT id, Home_team, Away_team, season, city, date,
         coalesce(toss_winner = Home_team, FALSE)::INTEGER AS Home_Toss_Won,
         coalesce(toss_winner = Home_team AND toss_decision = 'bat', FALSE)::INTEGER AS Home_Toss_Bat,
         coalesce(winner = Home_team, FALSE)::INTEGER AS Home_Team_Win,
         coalesce(toss_winner = Away_team, FALSE)::INTEGER AS Away_Toss_Won,
         coalesce(toss_winner = Away_team AND toss_decision = 'bat', FALSE)::INTEGER AS Away_Toss_Bat,
         coalesce(winner = Away_team, FALSE)::INTEGER AS Away_Team_Win
  FROM placed)"""

INNINGS = """
innings AS (
  SELECT match_id, batting_team, min(inning)::INTEGER AS inning, min(bowling_team) AS bowling_team,
         sum(off_bat + extra)::BIGINT AS Total_Runs, count(over_no) AS Total_Balls,
         max(over_no)::INTEGER AS Overs,
         count(*) FILTER (kind = 0) AS Total_wide, count(*) FILTER (kind = 1) AS Bye_Runs,
         count(*) FILTER (kind = 2) AS Leg_Bye, count(*) FILTER (kind = 3) AS Noball_runs,
         (5 * count(*) FILTER (kind = 4))::BIGINT AS penalty_runs, sum(extra)::BIGINT AS Extra_runs,
         nullif(count(*) FILTER (dismissed <> ''), 0) AS Number_Wickets,
         nullif(count(*) FILTER (off_bat = 4), 0) AS Number_4s,
         nullif(count(*) FILTER (off_bat = 6), 0) AS Number_6s,
         nullif(count(*) FILTER (off_bat = 0 AND extra = 0), 0) AS Dot_Balls,
         nullif(count(*) FILTER (kind <> 0), 0) AS Balls_Faced,
         (sum(off_bat + extra) FILTER (kind NOT IN (1, 2, 4)))::BIGINT AS Runs_Conceded
  FROM deliveries GROUP BY match_id, batting_team),
rated AS (
  SELECT *, (Total_Runs - Extra_runs) / Balls_Faced AS Batting_StrikeRate,
         (Total_Runs - Extra_runs) / Number_Wickets AS BattingAverage,
         Total_Balls / Number_Wickets AS Bowling_SR,
         Runs_Conceded / Number_Wickets AS Bowling_Avg,
         Total_Runs / nullif(Overs, 0) AS Bowling_Econ
  FROM innings),
indexed AS (
  SELECT *, BattingAverage * Batting_StrikeRate AS Batting_Index,
         Bowling_Avg * Bowling_SR AS Bowling_Index
  FROM rated),
batters AS (
  SELECT match_id, inning::INTEGER AS inning, batsman, min(batting_team) AS batting_team,
         min(bowling_team) AS bowling_team, sum(off_bat)::BIGINT AS total_runs,
         count(over_no) AS total_balls
  FROM deliveries WHERE kind <> 0 GROUP BY match_id, inning, batsman),
landmarks AS (
  SELECT match_id, batting_team, count(*) FILTER (total_runs >= 100) AS Century,
         count(*) FILTER (total_runs >= 50 AND total_runs < 100) AS Fifty
  FROM batters GROUP BY match_id, batting_team),
dated AS MATERIALIZED (
  SELECT i.*, coalesce(k.Century, 0) AS Century, coalesce(k.Fifty, 0) AS Fifty, m.date
  FROM indexed i LEFT JOIN landmarks k USING (match_id, batting_team)
  JOIN matches m ON m.id = i.match_id)"""

FORM = """
bat AS (
  SELECT match_id, date, batting_team AS Team, avg(Batting_Index) OVER w AS Batting_Index,
         avg(Bowling_Econ) OVER w AS Run_Rate, avg(Number_4s) OVER w AS Number_4s,
         avg(Number_6s) OVER w AS Number_6s, count(match_id) OVER w AS Matches_Played,
         avg(Century) OVER w AS Century, avg(Fifty) OVER w AS Fifty
  FROM dated
  WINDOW w AS (PARTITION BY batting_team ORDER BY date, match_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
bowl AS (
  SELECT match_id, date, bowling_team AS Team, avg(Bowling_Econ) OVER w AS Bowling_Econ,
         avg(Bowling_Index) OVER w AS Bowling_Index, avg(Extra_runs) OVER w AS AVG_Extras,
         avg(Overs) OVER w AS Avg_Overs, avg(Total_Balls) OVER w AS Avg_balls
  FROM dated
  WINDOW w AS (PARTITION BY bowling_team ORDER BY date, match_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
game_form AS (
  SELECT id, season, date, city, Home_team, Away_team, Home_Team_Win AS Home_team_Win,
         avg(Home_Toss_Won) OVER h AS Home_Avg_Toss_Won, avg(Home_Toss_Bat) OVER h AS Home_Avg_Bat_Won,
         avg(Home_Team_Win) OVER h AS Home_Avg_Wins, avg(Away_Toss_Won) OVER a AS Away_Avg_Toss_Won,
         avg(Away_Toss_Bat) OVER a AS Away_Avg_Bat_Won, avg(Away_Team_Win) OVER a AS Away_Avg_Wins
  FROM game_stats
  WINDOW h AS (PARTITION BY Home_team ORDER BY date, id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         a AS (PARTITION BY Away_team ORDER BY date, id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
form AS (
  SELECT b.match_id, b.Team, b.Batting_Index AS BI, b.Run_Rate AS RR, b.Number_4s AS n4,
         b.Number_6s AS n6, b.Matches_Played AS played, b.Century AS hundreds, b.Fifty AS fifties,
         o.Bowling_Index AS BoI, o.Bowling_Econ AS BoEcon, o.AVG_Extras AS Extras
  FROM bat b JOIN bowl o USING (match_id, Team))"""

_SIDE = "{f}.BI AS {s}_BI, {f}.RR AS {s}_RR, {f}.n4 AS {s}_4s, {f}.n6 AS {s}_6s, " \
    "{f}.played AS {s}_matchplayed, {f}.hundreds AS {s}_Centuries, {f}.fifties AS {s}_Fifties, " \
    "{f}.BoI AS {s}_BoI, {f}.BoEcon AS {s}_BoEcon, {f}.Extras AS {s}_Extras"

FINAL = f"""
home_stats AS (
  SELECT g.*, {_SIDE.format(f='h', s='Home')}
  FROM game_form g JOIN form h ON h.match_id = g.id AND h.Team = g.Home_team),
both_sides AS (
  SELECT g.*, {_SIDE.format(f='a', s='Away')}
  FROM home_stats g JOIN form a ON a.match_id = g.id AND a.Team = g.Away_team),
match_stats AS (
  SELECT b.* EXCLUDE (Home_team, Away_team), h.team_id AS Home_team, a.team_id AS Away_team
  FROM both_sides b LEFT JOIN teams h ON h.Team_name = b.Home_team
  LEFT JOIN teams a ON a.Team_name = b.Away_team),
final_diff AS MATERIALIZED (
  SELECT id, season, Home_team, Away_team, Home_team_Win, Home_BI - Away_BI AS Batting_Index,
         Home_RR - Away_RR AS Net_Run_Rate, Home_4s - Away_4s AS Fours, Home_6s - Away_6s AS Six,
         Home_matchplayed - Away_matchplayed AS matchplayed,
         Home_Centuries - Away_Centuries AS Centuries, Home_Fifties - Away_Fifties AS Fifties,
         Home_BoI - Away_BoI AS Bowling_Index, Home_Extras - Away_Extras AS Extras,
         Home_BoEcon - Away_BoEcon AS Bo_Econ,
         Home_Avg_Toss_Won - Away_Avg_Toss_Won AS Avg_Toss_Won,
         Home_Avg_Bat_Won - Away_Avg_Bat_Won AS AVG_Bat_Won,
         Home_Avg_Wins - Away_Avg_Wins AS AVG_Wins, date
  FROM match_stats)"""

def _r8(column: str) -> str:
    """Eight decimals: averages that differ only by the order of their sums become equal."""
    return f"floor({column} * 1e8::DOUBLE + 0.500001::DOUBLE) / 1e8::DOUBLE"


_NOT_NULL = " AND ".join(f"{c} IS NOT NULL" for c in ALL_18)
_MOMENTS = ", ".join(f"avg({c}) AS mean_{c}, stddev_pop({c}) AS sd_{c}" for c in ALL_18)
_WITHIN = " AND ".join(f"abs(({c} - mean_{c}) / nullif(sd_{c}, 0)) < 3" for c in ALL_18)

CLEAN = f"""
complete AS MATERIALIZED (
  SELECT {', '.join([*KEYS, 'Home_team_Win'])}, date,
         {', '.join(c if c == 'matchplayed' else f'{_r8(c)} AS {c}' for c in FEATURES)}
  FROM final_diff WHERE {_NOT_NULL}),
spread AS (SELECT {_MOMENTS} FROM complete),
cleaned AS MATERIALIZED (
  SELECT {', '.join(ALL_18)}, date FROM complete, spread WHERE {_WITHIN}),
whole AS (SELECT avg(Home_team_Win) AS rate, count(*) AS n FROM cleaned)"""


def _long(columns: list[str], table: str, keep: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {keep}, {i} AS place, '{c}' AS feature, {c}::DOUBLE AS x FROM {table}"
        for i, c in enumerate(columns)
    )


LONG = f"""
long AS MATERIALIZED ({_long(FEATURES, 'cleaned', 'id, date, Home_team_Win')})"""

RANKED = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY feature ORDER BY x, date, id) AS rank,
         count(*) OVER (PARTITION BY feature) AS n
  FROM long),
tenths AS MATERIALIZED (
  SELECT id, date, Home_team_Win, place, feature,
         greatest((((rank - 1) * 10 + n - 2) // (n - 1)) - 1, 0)::INTEGER AS bucket
  FROM ranked)"""

_EDGES = " + ".join(f"(x > step * {i}.0::DOUBLE + low)::INTEGER" for i in range(1, 8))
EIGHTHS = f"""
ends AS (
  SELECT feature, min(x) AS lo, max(x) AS hi,
         CASE WHEN min(x) < max(x) THEN 0 WHEN min(x) = 0 THEN 0.001::DOUBLE
              ELSE abs(min(x)) * 0.001::DOUBLE END AS pad
  FROM long GROUP BY feature),
edges AS (
  SELECT feature, lo - pad AS low, ((hi + pad) - (lo - pad)) / 8.0::DOUBLE AS step FROM ends),
eighths AS (SELECT l.*, ({_EDGES})::INTEGER AS bucket FROM long l JOIN edges USING (feature)),
eighth_stats AS (
  SELECT feature, bucket, count(*) AS bin_count, avg(Home_team_Win) AS bin_mean, avg(x) AS x_mean
  FROM eighths GROUP BY feature, bucket),
feature_msd AS (
  SELECT feature, sum((bin_mean - rate) ** 2) AS mean_sq_diff,
         sum((bin_mean - rate) ** 2 * bin_count / n) AS mean_sq_diff_weighted
  FROM eighth_stats, whole GROUP BY feature)"""

CELLS = """
cells AS (
  SELECT a.feature AS feature_1, b.feature AS feature_2, a.bucket AS bucket_1, b.bucket AS bucket_2,
         count(*) AS bin_count, avg(a.Home_team_Win) AS bin_mean
  FROM tenths a JOIN tenths b ON a.id = b.id AND a.place < b.place
  GROUP BY ALL),
pair_names AS (
  SELECT DISTINCT feature_1, feature_2 FROM cells),
grid AS (
  SELECT p.feature_1, p.feature_2, i.v::INTEGER AS bucket_1, j.v::INTEGER AS bucket_2,
         coalesce(c.bin_count, 0) AS bin_count, c.bin_mean,
         (c.bin_mean - w.rate) ** 2 * c.bin_count / w.n AS mean_sq_diff_weighted
  FROM pair_names p CROSS JOIN range(10) i(v) CROSS JOIN range(10) j(v) CROSS JOIN whole w
  LEFT JOIN cells c ON c.feature_1 = p.feature_1 AND c.feature_2 = p.feature_2
                   AND c.bucket_1 = i.v AND c.bucket_2 = j.v),
pair_msd AS (
  SELECT feature_1, feature_2, sum((bin_mean - rate) ** 2) AS mean_sq_diff,
         sum((bin_mean - rate) ** 2 * bin_count / n) AS mean_sq_diff_weighted
  FROM cells, whole GROUP BY feature_1, feature_2)"""

CORR = """
pair_corr AS (
  SELECT a.feature AS feature_1, b.feature AS feature_2, corr(a.x, b.x) AS correlation
  FROM long a JOIN long b ON a.id = b.id AND a.place < b.place GROUP BY ALL)"""


def _newton(steps: int) -> str:
    """The Newton steps of one-feature logistic fits, as chained expressions."""
    parts = ["fit_0 AS (SELECT DISTINCT feature, 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1 FROM long)"]
    for k in range(1, steps + 2):
        parts.append(f"""
state_{k} AS (
  SELECT feature, b0, b1, sum(y - p) AS g0, sum((y - p) * x) AS g1, sum(p * (1 - p)) AS h00,
         sum(p * (1 - p) * x) AS h01, sum(p * (1 - p) * x * x) AS h11
  FROM (SELECT l.feature, f.b0, f.b1, l.x, l.Home_team_Win AS y, 1 / (1 + exp(-(f.b0 + f.b1 * l.x))) AS p
        FROM long l JOIN fit_{k - 1} f USING (feature))
  GROUP BY feature, b0, b1),
fit_{k} AS (
  SELECT feature, b0 + (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01) AS b0,
         b1 + (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01) AS b1
  FROM state_{k})""")
    parts.append(f"""
logit AS (
  SELECT feature, b0 AS intercept, b1 AS slope, sqrt(h00 / (h00 * h11 - h01 * h01)) AS std_error,
         b1 / sqrt(h00 / (h00 * h11 - h01 * h01)) AS t_value
  FROM state_{steps + 1})""")
    # Two-sided p: Simpson's rule for the normal density from 0 to |z|, in 2,000 steps.
    parts.append("""
tails AS (
  SELECT feature, 1 - sqrt(2 / pi()) * any_value(abs(t_value)) / 6000
         * sum(CASE WHEN k IN (0, 2000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END
               * exp(-0.5::DOUBLE * (abs(t_value) * k / 2000) ** 2)) AS p_value
  FROM logit, range(2001) s(k) GROUP BY feature)""")
    return ",\n".join(parts)


NEWTON = _newton(10)

MATCH = ",".join([SOURCES, GAMES])
BALLS = ",".join([SOURCES, INNINGS])
CHAIN = ",".join([SOURCES, GAMES, INNINGS, FORM, FINAL])
CLEANED = ",".join([CHAIN, CLEAN])
LONGS = ",".join([CLEANED, LONG])

DIFF_OUT = f"id, season, Home_team, Away_team, Home_team_Win, {', '.join(c if c == 'matchplayed' else r6(c) + ' AS ' + c for c in FEATURES)}"
INNINGS_KEYS = "match_id, inning, batting_team, bowling_team"
FORM_RATES = "Home_Avg_Toss_Won Home_Avg_Bat_Won Home_Avg_Wins Away_Avg_Toss_Won Away_Avg_Bat_Won Away_Avg_Wins"


def _side_out(side: str) -> str:
    numbers = "BI RR 4s 6s Centuries Fifties BoI BoEcon Extras".split()
    return f"{side}_matchplayed, " + ", ".join(f"{r6(f'{side}_{c}')} AS {side}_{c}" for c in numbers)


FOLD = "('0x' || substr(md5(id || ':42'), 1, 8))::BIGINT % 5"


_RECURSIVE = "WITH RECURSIVE"


def _components(size: int, sweeps: int = 10) -> str:
    """Eigenpairs of the correlation matrix by cyclic rotations, each row of the recursion one."""
    cells = ",\n".join(
        "[" + ", ".join(f"coalesce(corr({a}::DOUBLE, {b}::DOUBLE), {int(a == b)})" for b in MODEL_16) + "]"
        for a in MODEL_16
    )
    rotated = "list_transform({m}, lambda row: list_transform(row, lambda x, j: CASE j WHEN p THEN co * row[p] - si * row[q] WHEN q THEN si * row[p] + co * row[q] ELSE x END))"
    return f"""start AS MATERIALIZED (SELECT [{cells}] AS a FROM cleaned),
steps AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sweep, p, q) AS k, p, q
  FROM (SELECT unnest(range({sweeps})) AS sweep), (SELECT unnest(range(1, {size})) AS p),
       (SELECT unnest(range(2, {size + 1})) AS q)
  WHERE p < q),
turned AS (
  SELECT 0::BIGINT AS k, a, list_transform(range(1, {size + 1}), lambda i:
           list_transform(range(1, {size + 1}), lambda j: (i = j)::INTEGER::DOUBLE)) AS v FROM start
  UNION ALL
  SELECT k, list_transform(half, lambda row, i: CASE i
             WHEN p THEN list_transform(row, lambda x, j: co * half[p][j] - si * half[q][j])
             WHEN q THEN list_transform(row, lambda x, j: si * half[p][j] + co * half[q][j])
             ELSE row END), w
  FROM (
    SELECT k, p, q, co, si, {rotated.format(m="a")} AS half, {rotated.format(m="v")} AS w
    FROM (
      SELECT *, 1 / sqrt(1 + t * t) AS co, t / sqrt(1 + t * t) AS si
      FROM (
        SELECT s.k, s.p, s.q, a, v,
               CASE WHEN abs(a[s.p][s.q]) < 1e-300 THEN 0
                    ELSE (CASE WHEN a[s.q][s.q] < a[s.p][s.p] THEN -1 ELSE 1 END)
                         / (abs((a[s.q][s.q] - a[s.p][s.p]) / (2 * a[s.p][s.q]))
                            + sqrt(1 + ((a[s.q][s.q] - a[s.p][s.p]) / (2 * a[s.p][s.q])) ** 2))
                         * sign(a[s.p][s.q]) END AS t
        FROM turned JOIN steps s ON s.k = turned.k + 1)))),
eigen AS (
  SELECT i, a[i][i] AS value, list_transform(v, lambda row: row[i]) AS axis
  FROM (SELECT a, v FROM turned ORDER BY k DESC LIMIT 1), (SELECT unnest(range(1, {size + 1})) AS i)),
shares AS (
  SELECT (row_number() OVER (ORDER BY value DESC) - 1)::INTEGER AS component, axis,
         value / sum(value) OVER () AS explained_ratio,
         list_position(list_transform(axis, lambda x: abs(x)), list_max(list_transform(axis, lambda x: abs(x)))) AS largest
  FROM eigen),
kept AS (
  SELECT * FROM (
    SELECT *, sum(explained_ratio) OVER (ORDER BY component) AS cumulative_ratio FROM shares)
  WHERE cumulative_ratio - explained_ratio <= 0.95)"""


# Discriminant weights of each fold: the pooled matrix and the class means, reduced by rows.
_DISCRIMINANT = """parts AS MATERIALIZED (
  SELECT id, ('0x' || substr(md5(id || ':42'), 1, 8))::BIGINT % 5 AS part, label, dim, v FROM vectors),
folds AS (SELECT unnest(range(5)) AS fold),
centres AS MATERIALIZED (
  SELECT fold, label, dim, avg(v) AS mean, count(*) AS n
  FROM parts JOIN folds ON part <> fold GROUP BY fold, label, dim),
gaps AS MATERIALIZED (
  SELECT fold, id, label, dim, v - mean AS d
  FROM parts JOIN folds ON part <> fold JOIN centres USING (fold, label, dim)),
pooled AS MATERIALIZED (
  SELECT x.fold, x.dim AS i, y.dim AS j, sum(x.d * y.d) AS s
  FROM gaps x JOIN gaps y ON y.fold = x.fold AND y.id = x.id GROUP BY ALL),
free AS (SELECT fold, count(DISTINCT id) - count(DISTINCT label) AS f FROM gaps GROUP BY fold),
means_of AS (SELECT fold, dim AS i, list(mean ORDER BY label) AS right_side FROM centres GROUP BY fold, dim),
rows_of AS (
  SELECT p.fold, p.i, list(s / f ORDER BY j) || any_value(right_side) AS line
  FROM pooled p JOIN free USING (fold) JOIN means_of m ON m.fold = p.fold AND m.i = p.i GROUP BY p.fold, p.i),
reduced AS (
  SELECT fold, 0::BIGINT AS k, list(line ORDER BY i) AS m FROM rows_of GROUP BY fold
  UNION ALL
  SELECT fold, k + 1, list_transform(m, lambda line, i: CASE WHEN i = k + 1 THEN top
           ELSE list_transform(line, lambda x, j: x - line[k + 1] * top[j]) END)
  FROM (SELECT fold, k, m, list_transform(m[k + 1], lambda x: x / m[k + 1][k + 1]) AS top
        FROM reduced WHERE k < len(m))),
solved AS MATERIALIZED (SELECT fold, m, len(m) AS d FROM reduced WHERE k = len(m)),
classes AS (
  SELECT fold, label, row_number() OVER (PARTITION BY fold ORDER BY label) AS place,
         n / sum(n) OVER (PARTITION BY fold) AS prior, means
  FROM (SELECT fold, label, max(n) AS n, list(mean ORDER BY dim) AS means FROM centres GROUP BY fold, label)),
weights AS MATERIALIZED (
  SELECT fold, label, list_transform(m, lambda line: line[d + place]) AS w, prior, means
  FROM classes JOIN solved USING (fold)),
points AS (SELECT id, part, label, list(v ORDER BY dim) AS x FROM parts GROUP BY id, part, label),
best AS (
  SELECT id, points.label, arg_max(w.label, ln(prior) + list_dot_product(x, w.w)
           - 0.5 * list_dot_product(means, w.w)) AS yhat
  FROM points JOIN weights w ON w.fold = points.part GROUP BY id, points.label)"""


def _tree_levels(depth: int) -> str:
    """Splits at the best of all values, level by level: ties by feature, then by value."""
    place = " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(FEATURES))
    parts = [
        f"""entries AS MATERIALIZED (
  SELECT id, feature, CASE feature {place} END AS place, x, Home_team_Win AS y FROM long)""",
        "at_0 AS MATERIALIZED (SELECT id, 1::BIGINT AS node, Home_team_Win AS y FROM cleaned)",
    ]
    for i in range(depth):
        parts.append(f"""sizes_{i} AS MATERIALIZED (
  SELECT node, count(*) AS n, sum(y)::BIGINT AS won FROM at_{i} GROUP BY node),
lists_{i} AS (
  SELECT node, feature, place, x, count(*) AS c, sum(e.y) AS w
  FROM entries e JOIN at_{i} USING (id) JOIN sizes_{i} s USING (node)
  WHERE s.won > 0 AND s.won < s.n GROUP BY ALL),
runs_{i} AS (
  SELECT node, feature, place, x, lead(x) OVER ranks AS next_x,
         (sum(c) OVER ranks)::DOUBLE AS l, (sum(w) OVER ranks)::DOUBLE AS lw
  FROM lists_{i} WINDOW ranks AS (PARTITION BY node, feature, place ORDER BY x)),
scored_{i} AS (
  SELECT r.node, feature, place, x, next_x,
         (lw * lw + (l - lw) * (l - lw)) / l
         + ((won - lw) * (won - lw) + (n - l - (won - lw)) * (n - l - (won - lw))) / (n - l) AS score
  FROM runs_{i} r JOIN (SELECT node, n::DOUBLE AS n, won::DOUBLE AS won FROM sizes_{i}) s USING (node)
  WHERE next_x IS NOT NULL),
splits_{i} AS MATERIALIZED (
  SELECT node, feature, (x + next_x) / 2 AS threshold FROM scored_{i}
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY score DESC, place, x) = 1),
at_{i + 1} AS MATERIALIZED (
  SELECT a.id, 2 * a.node + (e.x > s.threshold)::INTEGER AS node, a.y
  FROM at_{i} a JOIN splits_{i} s USING (node) JOIN entries e ON e.id = a.id AND e.feature = s.feature)""")
    every = " UNION ALL ".join(
        f"SELECT node, feature, threshold, n AS rows, won AS wins FROM sizes_{i} LEFT JOIN splits_{i} USING (node)"
        for i in range(depth)
    )
    parts.append(f"""tree AS (
  {every}
  UNION ALL SELECT node, NULL, NULL, count(*), sum(y)::BIGINT FROM at_{depth} GROUP BY node)""")
    return ",\n".join(parts)


def model_texts() -> dict[str, str]:
    q: dict[str, str] = {}
    length = " + ".join(f"{c}::DOUBLE ** 2" for c in MODEL_16)
    scaled = ", ".join(f"{c} / nullif(sqrt({length}), 0) AS {c}" for c in MODEL_16)
    q["row_normalise"] = f"""WITH {CLEANED}, unit AS (SELECT id, {scaled} FROM cleaned),
unit_long AS ({_long(MODEL_16, 'unit', 'id')})
SELECT id, feature, {r6('x')} AS value FROM unit_long"""
    q["standardise"] = f"""WITH {CLEANED}, raw AS MATERIALIZED ({_long(MODEL_16, 'cleaned', 'id')}),
stats AS (SELECT feature, avg(x) AS m, stddev_pop(x) AS s FROM raw GROUP BY feature)
SELECT id, feature, {r6('coalesce((x - m) / nullif(s, 0), 0)')} AS value FROM raw JOIN stats USING (feature)"""
    q["fold_assignment"] = f"WITH {CLEANED} SELECT id, ({FOLD})::INTEGER AS fold FROM cleaned"

    vectors = """vectors AS (
  SELECT vec_id AS id, label, unnest(embedding)::DOUBLE AS v,
         generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings)"""
    cells = f"""{vectors},
means AS MATERIALIZED (
  SELECT label, dim, avg(v) AS mean, count(*) AS rows FROM vectors GROUP BY label, dim),
apart AS MATERIALIZED (
  SELECT id, dim, v - mean AS d FROM vectors JOIN means USING (label, dim))"""
    q["lda_means"] = f"""WITH {cells}
SELECT label, dim::INTEGER AS dim, {r6_as('mean')}, rows FROM means"""
    q["lda_covariance"] = f"""WITH {cells},
freedom AS (SELECT count(*) - count(DISTINCT label) AS f FROM embeddings)
SELECT a.dim::INTEGER AS dim_1, b.dim::INTEGER AS dim_2, {r6('sum(a.d * b.d) / any_value(f)')} AS covariance
FROM apart a JOIN apart b USING (id), freedom GROUP BY a.dim, b.dim"""
    q["knn_predict"] = f"""WITH points AS MATERIALIZED (
  SELECT vec_id AS id, label, embedding::DOUBLE[] AS e,
         ('0x' || substr(md5(vec_id || ':42'), 1, 8))::BIGINT % 5 AS fold FROM embeddings),
near AS (
  SELECT t.id, s.label, row_number() OVER (
           PARTITION BY t.id ORDER BY list_distance(t.e, s.e), s.id) AS place
  FROM points t JOIN points s ON s.fold <> t.fold),
votes AS (SELECT id, label, count(*) AS n FROM near WHERE place <= 5 GROUP BY id, label)
SELECT id, arg_min(label, -n * 1000000 + label)::INTEGER AS yhat FROM votes GROUP BY id"""
    q["knn_predict_cells"] = q["knn_predict"]

    q["lda_weights"] = f"""WITH {cells}
SELECT label, dim::INTEGER AS dim, {r6_as('mean')} FROM means"""
    q["pca_reconstruction"] = f"""WITH {CLEANED}, raw AS MATERIALIZED ({_long(MODEL_16, 'cleaned', 'id')})
SELECT a.feature AS feature_1, b.feature AS feature_2, {r6('coalesce(corr(a.x, b.x), 0)')} AS correlation
FROM raw a JOIN raw b USING (id) GROUP BY ALL"""
    q["pca_variance"] = f"""{_RECURSIVE} {CLEANED}, {_components(len(MODEL_16))}
SELECT component, {r6_as('explained_ratio cumulative_ratio')} FROM kept"""
    q["pca_loadings"] = f"""{_RECURSIVE} {CLEANED}, {_components(len(MODEL_16))}
SELECT component, ([{', '.join(f"'{c}'" for c in MODEL_16)}])[i] AS feature,
       {r6('axis[i] * CASE WHEN axis[largest] < 0 THEN -1 ELSE 1 END')} AS loading
FROM kept, (SELECT unnest(range(1, {len(MODEL_16) + 1})) AS i)"""
    q["lda_predict"] = f"""{_RECURSIVE} {vectors}, {_DISCRIMINANT}
SELECT id, label::INTEGER AS label, yhat::INTEGER AS yhat FROM best"""
    q["cart_nodes"] = f"""WITH {LONGS}, {_tree_levels(3)}
SELECT node, feature, {r6('threshold')} AS threshold, rows, wins FROM tree"""
    q["cart_nodes_ranged"] = q["cart_nodes"]
    q["cart_stump"] = f"""WITH {LONGS}, {RANKED},
splits AS (
  SELECT t.feature, t.place, b.v AS bucket,
         count(*) FILTER (t.bucket <= b.v) AS rows_low,
         count(*) FILTER (t.bucket <= b.v AND Home_team_Win = 1) AS wins_low,
         count(*) FILTER (t.bucket > b.v) AS rows_high,
         count(*) FILTER (t.bucket > b.v AND Home_team_Win = 1) AS wins_high
  FROM tenths t, range(9) b(v) GROUP BY t.feature, t.place, b.v),
impure AS (
  SELECT *, 2 * wins_low * (1 - wins_low / rows_low) + 2 * wins_high * (1 - wins_high / rows_high) AS impurity
  FROM splits)
SELECT feature, bucket::INTEGER AS bucket, rows_low, wins_low, rows_high, wins_high
FROM impure ORDER BY impurity, place, bucket LIMIT 1"""

    metrics = f"""rule AS (
  SELECT id, ({FOLD})::INTEGER AS fold, Home_team_Win AS y, (AVG_Wins > 0)::INTEGER AS yhat,
         AVG_Wins AS score FROM cleaned),
per_class AS (
  SELECT fold, label, count(*) FILTER (y = label) AS support,
         count(*) FILTER (y = label AND yhat = label) AS hits,
         coalesce(count(*) FILTER (y = label AND yhat = label)
                  / nullif(count(*) FILTER (yhat = label), 0), 0) AS p
  FROM rule, (VALUES (0), (1)) c(label) GROUP BY fold, label),
rates AS (SELECT *, hits / nullif(support, 0) AS r FROM per_class),
score_ranks AS (
  SELECT fold, y, rank() OVER (PARTITION BY fold ORDER BY score)
         + (count(*) OVER (PARTITION BY fold, score) - 1) / 2 AS place FROM rule),
areas AS (
  SELECT fold, (sum(place) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2)
         / (count(*) FILTER (y = 1) * count(*) FILTER (y = 0)) AS auc FROM score_ranks GROUP BY fold),
wide AS (
  SELECT fold, sum(hits) / sum(support) AS accuracy, sum(p * support) / sum(support) AS precision_weighted,
         sum(r * support) / sum(support) AS recall_weighted,
         sum(coalesce(2 * p * r / nullif(p + r, 0), 0) * support) / sum(support) AS f1_weighted
  FROM rates GROUP BY fold),
scores AS (
  SELECT fold, 'accuracy' AS metric, accuracy AS value FROM wide
  UNION ALL SELECT fold, 'precision_weighted', precision_weighted FROM wide
  UNION ALL SELECT fold, 'recall_weighted', recall_weighted FROM wide
  UNION ALL SELECT fold, 'f1_weighted', f1_weighted FROM wide
  UNION ALL SELECT fold, 'roc_auc', auc FROM areas)"""
    q["fold_metrics"] = f"""WITH {CLEANED}, {metrics}
SELECT 'RULE' AS model, fold, metric, {r6('value')} AS value FROM scores"""
    q["fold_metrics_ranged"] = q["fold_metrics"]
    q["fold_boxplot"] = f"""WITH {CLEANED}, {metrics},
hits AS (SELECT value FROM scores WHERE metric = 'accuracy'),
box AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
               quantile_cont(value, 0.75) AS q3 FROM hits)
SELECT 'RULE' AS model, {r6('q1')} AS q1, {r6('median')} AS median, {r6('q3')} AS q3,
       {r6('min(value)')} AS low_whisker, {r6('max(value)')} AS high_whisker
FROM hits, box WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)
GROUP BY q1, median, q3"""
    return q


def sql_texts() -> dict[str, str]:
    q: dict[str, str] = {}
    q["source_matches"] = f"WITH {SOURCES} SELECT * FROM matches"
    q["source_deliveries"] = f"""WITH {SOURCES}
SELECT match_id, inning::INTEGER AS inning, batting_team, bowling_team, over_no AS over, over_no AS ball,
       batsman, off_bat AS batsman_runs, extra AS extra_runs, off_bat + extra AS total_runs,
       (kind = 0)::INTEGER AS wide_runs, (kind = 1)::INTEGER AS bye_runs,
       (kind = 2)::INTEGER AS legbye_runs, (kind = 3)::INTEGER AS noball_runs,
       CASE WHEN kind = 4 THEN 5 ELSE 0 END AS penalty_runs, dismissed AS player_dismissed
FROM deliveries"""
    q["home_away"] = f"WITH {MATCH} SELECT id, Home_team, Away_team FROM placed"
    q["match_indicators"] = f"WITH {MATCH} SELECT * FROM game_stats"
    q["innings_rollup"] = f"""WITH {BALLS}
SELECT {INNINGS_KEYS}, Total_Runs, Total_Balls, Overs, Total_wide, Bye_Runs, Leg_Bye, Noball_runs,
       penalty_runs, Extra_runs FROM innings"""
    q["innings_conditional_counts"] = f"""WITH {BALLS}
SELECT {INNINGS_KEYS}, Number_Wickets, Number_4s, Number_6s, Dot_Balls, Balls_Faced, Runs_Conceded
FROM innings"""
    q["innings_ratios"] = f"""WITH {BALLS}
SELECT {INNINGS_KEYS}, {r6_as('Batting_StrikeRate BattingAverage Bowling_SR Bowling_Avg Bowling_Econ Batting_Index Bowling_Index')}
FROM indexed"""
    q["batter_innings"] = f"WITH {BALLS} SELECT * FROM batters"
    q["milestones"] = f"""WITH {BALLS}
SELECT match_id, batting_team, Century, Fifty FROM dated"""
    q["innings_dated"] = f"WITH {BALLS} SELECT {INNINGS_KEYS}, date FROM dated"
    bat = f"""SELECT match_id, date, Team, Matches_Played,
       {r6_as('Batting_Index Run_Rate Number_4s Number_6s Century Fifty')} FROM bat"""
    bowl = f"""SELECT match_id, date, Team,
       {r6_as('Bowling_Econ Bowling_Index AVG_Extras Avg_Overs Avg_balls')} FROM bowl"""
    game = f"""SELECT id, season, date, city, Home_team, Away_team, Home_team_Win, {r6_as(FORM_RATES)}
FROM game_form"""
    for tail in ("", "_blocked"):
        q["rolling_batting" + tail] = f"WITH {CHAIN} {bat}"
        q["rolling_bowling" + tail] = f"WITH {CHAIN} {bowl}"
        q["rolling_home_away" + tail] = f"WITH {CHAIN} {game}"
    q["home_stats"] = f"""WITH {CHAIN}
SELECT id, season, date, city, Home_team, Away_team, Home_team_Win, {r6_as(FORM_RATES)}, {_side_out('Home')}
FROM home_stats"""
    q["away_stats"] = f"""WITH {CHAIN}
SELECT id, season, date, city, Home_team, Away_team, Home_team_Win, {r6_as(FORM_RATES)}, {_side_out('Home')},
       {_side_out('Away')}
FROM both_sides"""
    q["team_id_lookup"] = f"WITH {CHAIN} SELECT id, Home_team, Away_team FROM match_stats"
    q["final_diff"] = f"WITH {CHAIN} SELECT {DIFF_OUT} FROM final_diff"
    q["final_diff_blocked"] = q["final_diff"]
    q["tsv_roundtrip"] = q["final_diff"]
    q["table_roundtrip"] = q["final_diff"]
    q["table_named"] = q["final_diff"]
    ratio = {
        "Batting_Index": "BI", "Fours": "4s", "Six": "6s", "matchplayed": "matchplayed",
        "Centuries": "Centuries", "Fifties": "Fifties", "Bowling_Index": "BoI", "Extras": "Extras",
        "Avg_Toss_Won": "Avg_Toss_Won", "AVG_Bat_Won": "Avg_Bat_Won", "AVG_Wins": "Avg_Wins",
    }
    quotients = ", ".join(
        f"{r6(f'Home_{c} / nullif(Away_{c}, 0)')} AS {out}" for out, c in ratio.items()
    )
    q["final_ratio"] = f"""WITH {CHAIN}
SELECT id, season, Home_team, Away_team, Home_team_Win, {quotients} FROM match_stats"""
    q["head5"] = f"WITH {CHAIN} SELECT {DIFF_OUT} FROM final_diff ORDER BY date, id LIMIT 5"
    q["feature_long"] = f"WITH {LONGS} SELECT id, feature, {r6('x')} AS x FROM long"
    q["drop_nulls"] = f"WITH {CLEANED} SELECT id FROM complete"
    q["zscore_filter"] = f"WITH {CLEANED} SELECT id FROM cleaned"
    q["rank_first"] = f"WITH {LONGS}, {RANKED} SELECT id, feature, rank FROM ranked"
    q["rank_first_ranged"] = q["rank_first"]
    q["qcut10"] = f"WITH {LONGS}, {RANKED} SELECT id, feature, bucket FROM tenths"
    q["cut8"] = f"WITH {LONGS}, {EIGHTHS} SELECT id, feature, bucket FROM eighths"
    q["chrono_split"] = f"""WITH {CLEANED}
SELECT id, row_number() OVER (ORDER BY date, id) AS position,
       CASE WHEN row_number() OVER (ORDER BY date, id) <= 550 THEN 'train' ELSE 'test' END AS split
FROM cleaned"""
    q["response_rate"] = f"WITH {CLEANED} SELECT {r6('rate')} AS rate, n AS rows FROM whole"
    q["bucket_stats"] = f"""WITH {LONGS}, {EIGHTHS}
SELECT feature, bucket, bin_count, {r6_as('bin_mean x_mean')} FROM eighth_stats"""
    q["msd_univariate"] = f"""WITH {LONGS}, {EIGHTHS}
SELECT feature, {r6_as('mean_sq_diff mean_sq_diff_weighted')} FROM feature_msd"""
    paired = f"WITH {LONGS}, {RANKED}, {CELLS}"
    q["msd_pairs"] = f"""{paired}
SELECT feature_1, feature_2, {r6_as('mean_sq_diff mean_sq_diff_weighted')} FROM pair_msd"""
    q["bucket_grid"] = f"""{paired}
SELECT feature_1, feature_2, bucket_1, bucket_2, bin_count, {r6_as('bin_mean mean_sq_diff_weighted')}
FROM grid"""
    across = ", ".join(
        f"{r6(f'max(mean_sq_diff_weighted) FILTER (bucket_2 = {i})')} AS b{i}" for i in range(10)
    )
    q["grid_pivot"] = f"""{paired}
SELECT feature_1, feature_2, bucket_1, {across} FROM grid GROUP BY feature_1, feature_2, bucket_1"""
    q["corr_pairs"] = f"""WITH {LONGS}, {CORR}
SELECT feature_1, feature_2, {r6_as('correlation')} FROM pair_corr"""
    wide = f"long17 AS MATERIALIZED ({_long(PREDICTORS_17, 'cleaned', 'id')})"
    q["corr_matrix"] = f"""WITH {CLEANED}, {wide}
SELECT a.feature AS feature_1, b.feature AS feature_2, {r6('corr(a.x, b.x)')} AS correlation
FROM long17 a JOIN long17 b USING (id) GROUP BY ALL"""
    q["pair_report"] = f"""WITH {LONGS}, {RANKED}, {CELLS}, {CORR}
SELECT feature_1, feature_2, {r6_as('correlation mean_sq_diff mean_sq_diff_weighted')}
FROM pair_msd JOIN pair_corr USING (feature_1, feature_2)"""
    q["crosstab_response"] = f"""WITH {CHAIN}
SELECT city AS category, count(*) FILTER (Home_team_Win = 0) AS response_0,
       count(*) FILTER (Home_team_Win = 1) AS response_1
FROM game_form GROUP BY city"""
    q["category_msd"] = f"""WITH {CHAIN},
totals AS (SELECT avg(Home_team_Win) AS rate, count(*) AS n FROM game_form),
per_city AS (SELECT city, count(*) AS c, avg(Home_team_Win) AS m FROM game_form GROUP BY city)
SELECT 'city' AS feature, {r6('sum((m - rate) ** 2)')} AS mean_sq_diff,
       {r6('sum((m - rate) ** 2 * c / n)')} AS mean_sq_diff_weighted
FROM per_city, totals"""
    bounds = """bounds AS (
  SELECT feature, Home_team_Win, count(*) AS n, min(x) AS low, max(x) AS high, stddev_samp(x) AS sd
  FROM long GROUP BY feature, Home_team_Win)"""
    q["class_histogram"] = f"""WITH {LONGS}, {bounds}
SELECT feature, Home_team_Win, bin, {r6('low + bin * 0.2::DOUBLE')} AS bin_start, bin_count,
       {r6('bin_count / (n * 0.2::DOUBLE)')} AS density
FROM (SELECT l.feature, l.Home_team_Win, floor((x - low) / 0.2::DOUBLE)::BIGINT AS bin, low, n,
             count(*) AS bin_count
      FROM long l JOIN bounds b ON b.feature = l.feature AND b.Home_team_Win = l.Home_team_Win
      GROUP BY ALL)"""
    q["class_density"] = f"""WITH {LONGS}, {bounds},
grid AS (
  SELECT *, low + g.point * ((high - low) / 500.0::DOUBLE) AS at,
         sd * n ** (-0.2::DOUBLE) AS h
  FROM bounds, range(500) g(point))
SELECT g.feature, g.Home_team_Win, g.point::BIGINT AS point, {r6('any_value(g.at)')} AS x,
       {r6('sum(exp(-0.5::DOUBLE * ((g.at - l.x) / g.h) ** 2)) / (any_value(g.n) * any_value(g.h) * sqrt(2 * pi()))')} AS density
FROM grid g JOIN long l ON l.feature = g.feature AND l.Home_team_Win = g.Home_team_Win
WHERE g.sd > 0 GROUP BY g.feature, g.Home_team_Win, g.point"""
    q["ols_trend"] = f"""WITH {LONGS}
SELECT feature, {r6('regr_slope(Home_team_Win::DOUBLE, x)')} AS slope,
       {r6('regr_intercept(Home_team_Win::DOUBLE, x)')} AS intercept,
       {r6('regr_r2(Home_team_Win::DOUBLE, x)')} AS r2
FROM long GROUP BY feature"""
    q["univariate_logit"] = f"""WITH {LONGS}, {NEWTON}
SELECT feature, {r6_as('intercept slope std_error t_value p_value')} FROM logit JOIN tails USING (feature)"""
    q["feature_ranking"] = f"""WITH {LONGS}, {EIGHTHS}, {NEWTON}
SELECT feature, {r6_as('t_value p_value mean_sq_diff mean_sq_diff_weighted')}
FROM feature_msd JOIN logit USING (feature) JOIN tails USING (feature)"""
    q["feature_table"] = f"""WITH {LONGS}, {EIGHTHS}, {NEWTON}
SELECT feature, 'Continuous' AS kind, {r6('t_value')} AS t_value, printf('%.6e', p_value) AS p_value,
       {r6_as('mean_sq_diff mean_sq_diff_weighted')}
FROM feature_msd JOIN logit USING (feature) JOIN tails USING (feature)"""
    q["split_from_tsv"] = q["chrono_split"]
    q["report_roundtrip"] = q["pair_report"]
    q.update(model_texts())
    return q
