"""DuckDB SQL for every registered query that SQL can express.

Written against the raw tables with its own definitions of the booking views,
so a mistake in the DataFrame code cannot cancel out.
"""

from __future__ import annotations

# Fixed values of the data model, spelled out here as well: a slip in the
# library's own lists must not be a slip in its checks.
NUMERIC_FEATURES = [
    "lead_time", "adr", "arrival_date_year", "stays_in_weekend_nights", "stays_in_week_nights", "adults",
    "children", "is_repeated_guest", "previous_cancellations", "previous_bookings_not_canceled",
    "required_car_parking_spaces", "total_of_special_requests",
]
MARKET_SEGMENTS = ["Aviation", "Complementary", "Corporate", "Direct", "Groups", "Offline TA/TO", "Online TA"]
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
          "November", "December"]
MEALS = ["BB", "FB", "HB", "SC"]
ROOM_TYPES = ["A", "B", "C", "D", "E", "F", "G"]
WAREHOUSE_RENAMES = {"market_segment_Offline TA/TO": "market_segment_Offline_TA_TO",
                     "market_segment_Online TA": "market_segment_Online_TA"}
_KINDS = """
Booking_ID bigint, hotel string, is_canceled int, lead_time int, arrival_date_year int, arrival_date_month string,
arrival_date_week_number int, arrival_month string, arrival_date_day_of_month int, stays_in_weekend_nights int,
stays_in_week_nights int, adults int, children int, babies int, meal string, country string, market_segment string,
distribution_channel string, is_repeated_guest int, previous_cancellations int, previous_bookings_not_canceled int,
reserved_room_type string, assigned_room_type string, booking_changes int, deposit_type string, agent string,
company string, days_in_waiting_list int, customer_type string, adr double, required_car_parking_spaces int,
total_of_special_requests int, reservation_status string, reservation_status_date string"""

BOOKING_COLUMNS = dict(x.split() for x in _KINDS.split(","))
VOCABULARY = {"market_segment": MARKET_SEGMENTS, "arrival_date_month": sorted(MONTHS), "meal": MEALS,
              "reserved_room_type": ROOM_TYPES}
ONE_HOT = [f"{c}_{level}" for c, levels in VOCABULARY.items() for level in levels]

_BOOKINGS = """
raw_bookings AS (
  SELECT *, o_orderkey AS k, o_custkey AS c, (o_orderkey * 37) % 444 AS lead,
         1 + o_orderkey % 3 AS n_adults, (o_orderkey // 5) % 8 AS room,
         o_orderkey % 5 AS special, CAST(floor(o_totalprice) AS BIGINT) % 100 AS noise
  FROM orders),
bookings AS (
  SELECT k AS "Booking_ID",
    CASE WHEN c % 3 = 0 THEN 'Resort Hotel' ELSE 'City Hotel' END AS hotel,
    CASE WHEN noise < 10 + CASE WHEN lead > 220 THEN 50 ELSE 0 END + CASE WHEN special = 0 THEN 30 ELSE 0 END
         THEN 1 ELSE 0 END AS is_canceled,
    CAST(lead AS INTEGER) AS lead_time,
    CAST(year(o_orderdate) AS INTEGER) AS arrival_date_year,
    monthname(o_orderdate) AS arrival_date_month,
    CAST(weekofyear(o_orderdate) AS INTEGER) AS arrival_date_week_number,
    CAST(month(o_orderdate) AS VARCHAR) AS arrival_month,
    CAST(day(o_orderdate) AS INTEGER) AS arrival_date_day_of_month,
    CAST((k // 3) % 3 AS INTEGER) AS stays_in_weekend_nights,
    CAST((k // 9) % 6 AS INTEGER) AS stays_in_week_nights,
    CAST(n_adults AS INTEGER) AS adults,
    CAST(CASE WHEN k % 50 = 0 THEN NULL ELSE (k // 7) % 3 END AS INTEGER) AS children,
    CASE WHEN k % 17 = 0 THEN 1 ELSE 0 END AS babies,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'BB' WHEN '2-HIGH' THEN 'FB' WHEN '3-MEDIUM' THEN 'HB'
         WHEN '4-NOT SPECIFIED' THEN 'Undefined' ELSE 'SC' END AS meal,
    CASE WHEN c % 40 = 0 THEN NULL WHEN c % 41 = 0 THEN 'NA'
         ELSE ['PRT', 'GBR', 'FRA', 'ESP', 'DEU'][c % 5 + 1] END AS country,
    ['Aviation', 'Complementary', 'Corporate', 'Direct', 'Groups', 'Offline TA/TO',
     'Online TA', 'Online TA', 'Undefined'][c % 9 + 1] AS market_segment,
    ['TA/TO', 'Direct', 'Corporate', 'GDS'][c % 4 + 1] AS distribution_channel,
    CASE WHEN k % 10 = 0 THEN 1 ELSE 0 END AS is_repeated_guest,
    CAST((k // 2) % 2 AS INTEGER) AS previous_cancellations,
    0 AS previous_bookings_not_canceled,
    chr(CAST(65 + room AS INTEGER)) AS reserved_room_type,
    chr(CAST(65 + (k // 11) % 8 AS INTEGER)) AS assigned_room_type,
    CAST(k % 4 AS INTEGER) AS booking_changes,
    CASE WHEN k % 13 = 0 THEN 'Non Refund' ELSE 'No Deposit' END AS deposit_type,
    CASE WHEN c % 6 = 0 THEN NULL ELSE CAST(c % 300 AS VARCHAR) END AS agent,
    CASE WHEN c % 10 = 0 THEN CAST(c % 50 AS VARCHAR) ELSE NULL END AS company,
    CAST(CASE WHEN k % 25 = 0 THEN k % 90 ELSE 0 END AS INTEGER) AS days_in_waiting_list,
    ['Transient', 'Contract', 'Transient-Party', 'Group'][c % 4 + 1] AS customer_type,
    floor(2::DOUBLE * (50 * n_adults - 40 + 0.25::DOUBLE * lead + 8 * room + 4 * month(o_orderdate)
                       + o_totalprice / 5000::DOUBLE)) / 2::DOUBLE AS adr,
    CAST((k // 13) % 4 AS INTEGER) AS required_car_parking_spaces,
    CAST(special AS INTEGER) AS total_of_special_requests,
    CASE WHEN noise < 10 + CASE WHEN lead > 220 THEN 50 ELSE 0 END + CASE WHEN special = 0 THEN 30 ELSE 0 END
         THEN 'Canceled' ELSE 'Check-Out' END AS reservation_status,
    strftime(o_orderdate, '%Y-%m-%d') AS reservation_status_date
  FROM raw_bookings)"""

_LISTINGS = """
listings AS (
  SELECT p_partkey AS listing_id, p_partkey % 97 AS host_id,
    ['Entire home/apt', 'Private room', 'Shared room'][p_size % 3 + 1] AS room_type,
    p_brand AS neighbourhood, CAST(p_size * 3 AS BIGINT) AS reviews,
    (p_size % 11) / 2::DOUBLE AS overall_satisfaction,
    CAST(CASE WHEN p_partkey % 20 = 0 THEN NULL ELSE p_size % 14 END AS BIGINT) AS accommodates,
    CAST(CASE WHEN p_partkey % 30 = 0 THEN NULL ELSE p_size % 8 END AS BIGINT) AS bedrooms,
    p_retailprice AS price,
    CAST(CASE WHEN p_partkey % 40 = 0 THEN NULL ELSE p_size % 7 END AS BIGINT) AS minstay,
    38.5::DOUBLE + (p_partkey % 100) / 1000::DOUBLE AS latitude,
    -9.5::DOUBLE + (p_partkey % 90) / 1000::DOUBLE AS longitude,
    DATE '2017-01-01' + CAST(p_partkey % 365 AS INTEGER) AS date
  FROM part)"""

_FEED_ID = ("'INN' || lpad(CAST(\"Booking_ID\" AS VARCHAR), "
            "CAST(greatest(12, length(CAST(\"Booking_ID\" AS VARCHAR))) AS INTEGER), '0')")
# Column order of the monthly feed, as its header states it.
_FEED = [
    "Booking_ID", "adults", "children", "stays_in_weekend_nights", "stays_in_week_nights", "meal",
    "required_car_parking_spaces", "reserved_room_type", "lead_time", "arrival_date_year",
    "arrival_date_month", "arrival_date_day_of_month", "market_segment", "is_repeated_guest",
    "previous_cancellations", "previous_bookings_not_canceled", "adr", "total_of_special_requests",
    "is_canceled",
]
_IN_RANGE = "adr > 50 AND adr <= 400"
_FORMULA = "50.0::DOUBLE * adults + 0.25::DOUBLE * lead_time + 30.0::DOUBLE"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts)


def _q(name: str) -> str:
    return '"' + name + '"'


def _flag(column: str, level: str) -> str:
    return f"CASE WHEN {column} = '{level}' THEN 1 ELSE 0 END AS {_q(f'{column}_{level}')}"


def _flags(column: str, levels: list[str]) -> list[str]:
    return [_flag(column, level) for level in levels]


_ALL_FLAGS = [f for c, levels in VOCABULARY.items() for f in _flags(c, levels)]
_PLAIN = [c for c in NUMERIC_FEATURES if c not in ("adr", "children", "required_car_parking_spaces", "arrival_date_year")]

# Historical price features: recoded meal, capped parking, filtered and rounded rate.
_PRICE = f"""
price_clean AS (
  SELECT {", ".join(_PLAIN)}, arrival_date_year, "Booking_ID", market_segment, arrival_date_month,
    reserved_room_type, CASE WHEN meal = 'Undefined' THEN 'SC' ELSE meal END AS meal,
    coalesce(children, 0) AS children,
    CASE WHEN required_car_parking_spaces > 1 THEN 1 ELSE required_car_parking_spaces END AS required_car_parking_spaces,
    CAST(round_even(adr, 0) AS INTEGER) AS adr
  FROM bookings WHERE {_IN_RANGE}),
price AS (
  SELECT {", ".join(NUMERIC_FEATURES)}, {", ".join(_ALL_FLAGS)}, "Booking_ID", 0::DOUBLE AS predicted
  FROM price_clean)"""

_CANCEL_COLUMNS = (
    f'{", ".join(_PLAIN)}, coalesce(children, 0) AS children, required_car_parking_spaces, '
    f'0 AS arrival_date_year, adr, "Booking_ID", is_canceled, 0 AS predicted'
)
_CANCEL = f"""
cancel AS (SELECT {_CANCEL_COLUMNS}, {", ".join(_ALL_FLAGS)} FROM bookings)"""

# Monthly features: raw meal and parking, filtered and rounded rate.
_MONTHLY = f"""
monthly AS (
  SELECT {", ".join(_PLAIN)}, coalesce(children, 0) AS children, required_car_parking_spaces,
    arrival_date_year, CAST(round_even(adr, 0) AS INTEGER) AS adr, "Booking_ID", is_canceled,
    {", ".join(_ALL_FLAGS)}
  FROM bookings WHERE {_IN_RANGE})"""

_BUCKET = "('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8))::BIGINT % 100"
_SPLIT = _BUCKET.format(key='"Booking_ID"')
_RENAMED = ", ".join(
    f"{_q(old)} AS {_q(new)}" for old, new in WAREHOUSE_RENAMES.items())
_SAFE = f"* EXCLUDE ({', '.join(map(_q, WAREHOUSE_RENAMES))}), {_RENAMED}"

_BASES = _with(_BOOKINGS)
_PRICES = _with(_BOOKINGS, _PRICE)
_CANCELS = _with(_BOOKINGS, _CANCEL)

_MESSAGES = f"""
feed AS (
  SELECT {_FEED_ID} AS id_text, * FROM bookings),
feed_rows AS (
  SELECT arrival_date_year * 12 + CAST(arrival_month AS INTEGER) - 1 AS month, "Booking_ID" + 2 AS position,
    {" || ',' || ".join("id_text" if c == "Booking_ID" else f"coalesce(CAST({c} AS VARCHAR), '')" for c in _FEED)} AS value
  FROM feed),
controls AS (
  SELECT month, unnest([0, 1, max(position) + 1]) AS position,
    unnest(['START', '{",".join(_FEED)}', 'END']) AS value
  FROM feed_rows GROUP BY month),
log AS (
  SELECT 'bookings' AS topic, CAST(month % 2 AS INTEGER) AS partition,
    month * {10 ** 13} + 2 * position AS "offset", value
  FROM (SELECT * FROM feed_rows UNION ALL SELECT * FROM controls))"""

_EVENT_LOG = """
log AS (
  SELECT 'events' AS topic, CAST(user_id % 4 AS INTEGER) AS partition, event_id AS "offset",
    CASE event_type WHEN 'signup' THEN 'START' WHEN 'purchase' THEN 'END' ELSE event_type END AS value
  FROM events),
framed AS (
  SELECT *, sum(CASE WHEN value = 'START' THEN 1 ELSE 0 END)
    OVER (PARTITION BY partition ORDER BY "offset" ROWS UNBOUNDED PRECEDING) AS frame_id
  FROM log)"""


def _union(selects: list[str]) -> str:
    return "\nUNION ALL\n".join(selects)


def _r(expr: str, digits: int = 6) -> str:
    return f"round({expr}, {digits})"


def _moments(x: str, y: str) -> str:
    """Pearson from centred sums; NULL when a column is constant."""
    return (f"sum(({x} - avg_{x}) * ({y} - avg_{y})) / "
            f"nullif(sqrt(sum(({x} - avg_{x}) ** 2) * sum(({y} - avg_{y}) ** 2)), 0)")


def _correlations(columns: list[str], pairs: list[tuple[str, str]], line) -> str:
    short = {c: f"v{i}" for i, c in enumerate(columns)}
    values = ", ".join(f"CAST({_q(c)} AS DOUBLE) AS {s}" for c, s in short.items())
    means = ", ".join(f"avg({s}) AS avg_{s}" for s in short.values())
    corrs = ", ".join(f"{_moments(short[x], short[y])} AS c{i}" for i, (x, y) in enumerate(pairs))
    rows = _union([line(x, y, f"c{i}") for i, (x, y) in enumerate(pairs)])
    return _with(
        _BOOKINGS, _PRICE, f"vals AS (SELECT {values} FROM price)",
        f"means AS (SELECT {means} FROM vals)",
        f"corrs AS (SELECT {corrs} FROM vals, means)") + "\n" + rows


def _describe(column: str) -> str:
    v = f"CAST({column} AS DOUBLE)"
    return f"""SELECT '{column}' AS column_name, count({column}) AS n, {_r(f"avg({v})")} AS mean,
      {_r(f"stddev_samp({v})")} AS std, {_r(f"min({v})")} AS min,
      {_r(f"quantile_cont({v}, 0.25)")} AS q25, {_r(f"quantile_cont({v}, 0.5)")} AS q50,
      {_r(f"quantile_cont({v}, 0.75)")} AS q75, {_r(f"max({v})")} AS max FROM bookings"""


def _boxes(stage: str, column: str, where: str) -> str:
    v = f"CAST({column} AS DOUBLE)"
    return f"""SELECT '{column}' AS column_name, '{stage}' AS stage, {_r("q1")} AS q1, {_r("q2")} AS median,
      {_r("q3")} AS q3,
      {_r("min(CASE WHEN v >= low AND v <= high THEN v END)")} AS whisker_low,
      {_r("max(CASE WHEN v >= low AND v <= high THEN v END)")} AS whisker_high,
      CAST(sum(CASE WHEN v < low THEN 1 ELSE 0 END) AS BIGINT) AS n_below,
      CAST(sum(CASE WHEN v > high THEN 1 ELSE 0 END) AS BIGINT) AS n_above
    FROM (SELECT v, q1, q2, q3, q1 - 3 * (q3 - q1) AS low, q3 + 3 * (q3 - q1) AS high FROM
      (SELECT {v} AS v FROM bookings WHERE {where}),
      (SELECT quantile_cont({v}, 0.25) AS q1, quantile_cont({v}, 0.5) AS q2, quantile_cont({v}, 0.75) AS q3
       FROM bookings WHERE {where}))
    GROUP BY q1, q2, q3, low, high"""


def _leaderboard() -> str:
    segment_means = " ".join(
        f"WHEN {_q('market_segment_' + s)} = 1 THEN (SELECT avg(adr) FROM train WHERE {_q('market_segment_' + s)} = 1)"
        for s in MARKET_SEGMENTS)
    candidates = {
        "global_mean": "(SELECT avg(adr) FROM train)",
        "segment_mean": f"CASE {segment_means} ELSE (SELECT avg(adr) FROM train) END",
        "adults_lead_formula": _FORMULA,
        "lead_formula": "0.25::DOUBLE * lead_time + 150.0::DOUBLE",
        "adults_lead_formula_again": _FORMULA,
    }
    rows = _union([
        f"SELECT {i} AS ordinal, '{name}' AS candidate, avg((adr - p) ** 2) AS mse, "
        f"1 - avg((adr - p) ** 2) / var_pop(adr) AS r2 FROM (SELECT adr, {expr} AS p FROM test)"
        for i, (name, expr) in enumerate(candidates.items())])
    return _with(
        _BOOKINGS, _PRICE, f"train AS (SELECT * FROM price WHERE {_SPLIT} < 80)",
        f"test AS (SELECT * FROM price WHERE {_SPLIT} >= 80)", f"board AS ({rows})")


def _onehot(column: str, levels: list[str]) -> str:
    return f'{_BASES} SELECT "Booking_ID", {", ".join(_flags(column, levels))} FROM bookings'


def _observed() -> dict[str, list[str]]:
    """Levels that occur in the booking view."""
    return {
        "market_segment": MARKET_SEGMENTS + ["Undefined"], "arrival_date_month": MONTHS,
        "meal": ["BB", "FB", "HB", "SC", "Undefined"], "reserved_room_type": ROOM_TYPES + ["H"],
    }


def _unknown() -> str:
    return _union([
        f"SELECT '{c}' AS column_name, {c} AS level, count(*) AS n_rows FROM bookings "
        f"WHERE {c} NOT IN ({', '.join(repr(v) for v in levels)}) GROUP BY {c}"
        for c, levels in VOCABULARY.items()])


def _scaled() -> str:
    filled = ", ".join("coalesce(children, 0) AS children" if c == "children" else c for c in NUMERIC_FEATURES)
    stats = ", ".join(
        f"avg(CAST({c} AS DOUBLE)) AS m_{c}, stddev_pop(CAST({c} AS DOUBLE)) AS s_{c}" for c in NUMERIC_FEATURES)
    cells = ", ".join(
        f"{_r(f'({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END')} AS {c}" for c in NUMERIC_FEATURES)
    return _with(
        _BOOKINGS, f'filled AS (SELECT "Booking_ID", {filled} FROM bookings)',
        f"stats AS (SELECT {stats} FROM filled)") + f'\nSELECT "Booking_ID", {cells} FROM filled, stats'


_MONTHLY_PRICE = _with(_BOOKINGS, _MONTHLY) + "\nSELECT * EXCLUDE (is_canceled), 0::DOUBLE AS predicted FROM monthly"
_KNN = f"""
WITH parts AS (SELECT *, {_BUCKET.format(key="vec_id")} AS bucket FROM embeddings),
pairs AS (
  SELECT q.vec_id AS vec_id, t.vec_id AS train_id, t.label AS label,
    list_sum(list_transform(list_zip(q.embedding, t.embedding),
             lambda z: power(z[1]::DOUBLE - z[2]::DOUBLE, 2))) AS distance
  FROM (SELECT * FROM parts WHERE bucket >= 80) q, (SELECT * FROM parts WHERE bucket < 80) t),
nearest AS (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, train_id) AS place FROM pairs),
votes AS (SELECT vec_id, label, count(*) AS n FROM nearest WHERE place <= 5 GROUP BY vec_id, label)
SELECT vec_id, label AS prediction FROM
  (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY n DESC, label) AS place FROM votes)
WHERE place = 1"""


def _regression_facts(name: str, extra: str = "") -> str:
    """Facts of a regression's hold-out; a fit that doesn't beat the training mean would differ."""
    return f"""{_PRICES}, parts AS (SELECT adr, {_SPLIT} < 80 AS train FROM price),
        base AS (SELECT avg(adr) AS guess FROM parts WHERE train)
        SELECT '{name}' AS model, count(*) AS n_rows, {_r("avg(adr)")} AS label_mean,
        {_r("avg((adr - guess) ** 2)")} AS baseline_mse, true AS beats_baseline{extra}
        FROM parts, base WHERE NOT train"""


def _class_facts(name: str, target: str, bands: str) -> str:
    rows = f"{_CANCELS}, labelled AS (SELECT \"Booking_ID\", is_canceled AS label FROM cancel)" \
        if target == "is_canceled" else f"{_PRICES}, {bands}, labelled AS (SELECT \"Booking_ID\", adr_category AS label FROM banded)"
    return f"""{rows}, parts AS (SELECT label, {_SPLIT} < 80 AS train FROM labelled),
        base AS (SELECT label AS guess FROM parts WHERE train GROUP BY label ORDER BY count(*) DESC, label LIMIT 1)
        SELECT '{name}' AS model, '{target}' AS target, count(*) AS n_rows, count(DISTINCT label) AS n_classes,
        {_r("avg(CASE WHEN label = guess THEN 1.0::DOUBLE ELSE 0 END)")} AS baseline_accuracy, true AS beats_baseline
        FROM parts, base WHERE NOT train"""


def _first_split(base: str, table: str, label: str, start: str, hessian: str) -> str:
    """The first cut of second-order boosting from all cuts of all predictors, and the weights on its two sides.

    Gradients are the mean less the label; l2 is 1, the rate 0.3, and each side has a hessian of 1 at least.
    """
    names = [c for c in [*NUMERIC_FEATURES, *ONE_HOT]
             if c != "adr" and not (table == "cancel" and c == "arrival_date_year")]
    names = names if table == "price" else ["adr", *names]
    places = {c: i for i, c in enumerate(names)}
    long = " UNION ALL ".join(
        f"SELECT {i} AS place, '{c}' AS feature, CAST({_q(c)} AS DOUBLE) AS x, y FROM train" for c, i in places.items())
    return f"""{base}, train AS (SELECT *, CAST({label} AS DOUBLE) AS y FROM {table} WHERE {_SPLIT} < 80),
        facts AS (SELECT avg(y) AS mean, {start} AS start FROM train), long AS ({long}),
        cells AS (SELECT place, feature, x, sum(mean - y) AS g, count(*) * any_value({hessian}) AS h
                  FROM long, facts GROUP BY place, feature, x),
        sides AS (SELECT *, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(g) OVER (PARTITION BY place) AS gt,
                  sum(h) OVER (PARTITION BY place) AS ht, lead(x) OVER w AS following
                  FROM cells WINDOW w AS (PARTITION BY place ORDER BY x)),
        best AS (SELECT * FROM sides WHERE following IS NOT NULL AND hl >= 1 AND ht - hl >= 1
                 ORDER BY gl ** 2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) DESC, place, x LIMIT 1)
        SELECT feature, x AS threshold, {_r("start")} AS start, {_r("-0.3 * gl / (hl + 1)")} AS left_value,
        {_r("-0.3 * (gt - gl) / (ht - hl + 1)")} AS right_value FROM best, facts"""


def _encoded() -> str:
    names = [*VOCABULARY, "country"]
    mean = "(SELECT avg(is_canceled) FROM bookings)"
    cells = ", ".join(
        f"round((coalesce(sum(is_canceled) OVER w_{c}, 0) + 1.0::DOUBLE * {mean}) / (count(is_canceled) OVER w_{c} + 1.0::DOUBLE), 9) AS {c}_target"
        for c in names)
    windows = ", ".join(f'w_{c} AS (PARTITION BY {c} ORDER BY h, "Booking_ID" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)'
                        for c in names)
    return f"""{_with(_BOOKINGS)}, hashed AS (
        SELECT *, ('0x' || substr(md5(CAST("Booking_ID" AS VARCHAR)), 1, 15))::BIGINT AS h FROM bookings)
        SELECT "Booking_ID", {", ".join(names)}, is_canceled, {cells} FROM hashed WINDOW {windows}"""


def _learners(bands: str) -> dict[str, str]:
    """What SQL can say about the learners: rows, baselines and identities that any right fit meets."""
    sql = {f"reg_{n}": _regression_facts(n) for n in (
        "elastic_net", "random_forest", "gbt", "gbt_deep", "gbt_subsample", "gbt_indexed", "bayesian_ridge", "leafwise",
        "second_order", "ordered")}
    sql["reg_linear"] = _regression_facts("linear", ", 0.0::DOUBLE AS normal_residual")
    for name in ("logistic_scaled", "gbt", "gbt_indexed", "knn", "ordered"):
        sql[f"cls_{name}"] = _class_facts(name, "is_canceled", bands)
    for name in ("decision_tree", "extra_trees", "gbt_multiclass", "gbt_deep"):
        sql[f"cls_{name}"] = _class_facts(name, "adr_category", bands)
    sql["knn_classify_band"] = _class_facts("knn", "adr_category", bands)
    sql["cls_leafwise_bands"] = _class_facts("leafwise", "adr_category", bands)
    sql["reg_second_order_stump"] = _first_split(_PRICES, "price", "adr", "avg(y)", "1.0::DOUBLE")
    sql["cls_second_order_stump"] = _first_split(
        _CANCELS, "cancel", "is_canceled", "ln(avg(y) / (1 - avg(y)))", "mean * (1 - mean)")
    for name in ("logistic", "random_forest", "adaboost"):
        both = [f"SELECT * FROM ({_class_facts(name, t, bands)})" for t in ("is_canceled", "adr_category")]
        sql[f"cls_{name}"] = " UNION ALL ".join(both)
    columns = [_q(f"market_segment_{s}") for s in ("Direct", "Groups", "Offline TA/TO", "Online TA")]
    sql["pca_scores"] = f"""{_PRICES} SELECT count(*) AS n_rows, 0.0::DOUBLE AS largest_mean,
        0.0::DOUBLE AS largest_covariance, {_r(" + ".join(f"var_samp({c})" for c in columns))} AS total_variance FROM price"""
    squares = " + ".join(f"corr({x}, {y}) ** 2" for x in columns for y in columns)
    sql["pca_variance"] = f"""{_PRICES} SELECT {len(columns)}::BIGINT AS n_components, 1.0::DOUBLE AS ratio_sum,
        {_r(squares)} AS squared_norm FROM price"""
    for name in ("score_price", "score_cancel"):
        sql[name] = _with(_BOOKINGS, _MONTHLY) + f"""
            SELECT count(*) AS n_rows, count(*) AS n_scored, {_r("sum(CAST(adr AS DOUBLE))", 4)} AS total_adr
            FROM monthly WHERE {_SPLIT} >= 80"""
    sql["retrain_champion"] = " UNION ALL ".join(
        f"SELECT * FROM ({base} SELECT '{target}' AS target, count(*) AS n_rows, true AS best_promoted, "
        f"0::BIGINT AS n_different FROM {table} WHERE {_SPLIT} >= 80)"
        for target, base, table in (("price", _PRICES, "price"), ("cancel", _CANCELS, "cancel")))
    return sql


def oracles() -> dict[str, str]:
    categorical = list(VOCABULARY)
    price_inputs = ", ".join(['"Booking_ID"', *NUMERIC_FEATURES, *categorical])
    cancel_inputs = ", ".join(
        ['"Booking_ID"', *[c for c in NUMERIC_FEATURES if c != "arrival_date_year"], *categorical, "is_canceled"])
    unused = ("arrival_date_week_number, babies, country, distribution_channel, assigned_room_type, "
              "booking_changes, deposit_type, agent, company, days_in_waiting_list, customer_type, "
              "reservation_status, reservation_status_date, hotel")
    months = {q: ",".join(MONTHS[3 * q - 3:3 * q]) for q in (1, 2, 3, 4)}
    july, august, september = (f'"arrival_date_month_{m}" = 1' for m in ("July", "August", "September"))
    # The edges of the rate bands.
    edges = [49, 75, 100, 125, 150, 175, 200, 225, 250, 275, 300, 325, 350, 375, 400]
    bands = " ".join(f"WHEN adr > {low} AND adr <= {high} THEN {i}"
                     for i, (low, high) in enumerate(zip(edges, edges[1:]), start=1))
    rounded = f'SELECT "Booking_ID", CAST(round_even(adr, 0) AS INTEGER) AS adr FROM bookings WHERE {_IN_RANGE}'
    band_case = f"CASE {bands} END"
    pairs = [(x, y) for i, x in enumerate(NUMERIC_FEATURES) for y in NUMERIC_FEATURES[i:]]
    observed = _observed()

    def corr_line(x: str, y: str, c: str) -> str:
        both = [f"SELECT '{x}' AS column_x, '{y}' AS column_y, {_r(c)} AS corr FROM corrs"]
        if x != y:
            both.append(f"SELECT '{y}', '{x}', {_r(c)} FROM corrs")
        return _union(both)

    rank_columns = NUMERIC_FEATURES + ONE_HOT
    sql = {
        "price_select": f"{_BASES} SELECT {price_inputs} FROM bookings",
        "cancel_select": f"{_BASES} SELECT {cancel_inputs} FROM bookings",
        "drop_unused": f"{_BASES} SELECT * EXCLUDE ({unused}) FROM bookings",
        "price_preparation": f"""{_BASES} SELECT * EXCLUDE ({unused}, is_canceled, arrival_date_day_of_month)
            FROM bookings WHERE hotel = 'City Hotel'""",
        "rename_columns": f"{_PRICES} SELECT {_SAFE} FROM price",
        "cast_ints": f"""{_BASES} SELECT "Booking_ID", CAST(trunc(adr) AS INTEGER) AS adr_int,
            CAST(arrival_month AS INTEGER) AS arrival_month_int, coalesce(children, 0) AS children_int FROM bookings""",
        "booking_id_parse": f'{_BASES} SELECT {_FEED_ID} AS "Booking_ID", "Booking_ID" AS booking_number FROM bookings',
        "conform_price": f"{_PRICES} SELECT * FROM price",
        "conform_cancel": f"{_CANCELS} SELECT * FROM cancel",
        "conform_unknown": f"""{_BASES} SELECT {_CANCEL_COLUMNS},
            {", ".join(f for c, levels in observed.items() for f in _flags(c, levels))} FROM bookings""",
        "monthly_price": _MONTHLY_PRICE,
        "monthly_cancel": _with(_BOOKINGS, _MONTHLY)
        + "\nSELECT * EXCLUDE (adr), CAST(adr AS DOUBLE) AS adr, 0 AS predicted FROM monthly",
        "eda_passthrough": f"{_BASES} SELECT * FROM bookings",
        "fill_missing": f"""{_BASES} SELECT "Booking_ID", coalesce(children, 0) AS children,
            coalesce(country, 'Unknown') AS country FROM bookings""",
        "presence_labels": f"""{_BASES} SELECT "Booking_ID",
            CASE WHEN agent IS NOT NULL THEN 'Agent' ELSE 'No Agent' END AS agent,
            CASE WHEN company IS NOT NULL THEN 'Corporate' ELSE 'No Company' END AS company FROM bookings""",
        "recode_meal": f"""{_BASES} SELECT "Booking_ID",
            CASE WHEN meal = 'Undefined' THEN 'SC' ELSE meal END AS meal FROM bookings""",
        "clamp_parking": f"""{_BASES} SELECT "Booking_ID", CASE WHEN required_car_parking_spaces > 1 THEN 1
            ELSE required_car_parking_spaces END AS required_car_parking_spaces FROM bookings""",
        "adr_range_filter": f'{_BASES} SELECT "Booking_ID", adr FROM bookings WHERE {_IN_RANGE}',
        "listing_clean": _with(_LISTINGS) + """
            SELECT * FROM listings WHERE (accommodates IS NULL OR accommodates <= 10)
            AND (bedrooms IS NULL OR bedrooms <= 5) AND (minstay IS NULL OR minstay <= 5)""",
        "split_by_value": f'{_BASES} SELECT "Booking_ID", adr, hotel AS subset FROM bookings',
        "quarter_slice_literal": f"""{_PRICES} SELECT * FROM price
            WHERE {july} OR {august} OR {september} AND arrival_date_year = 1997""",
        "quarter_slice": f"""{_PRICES} SELECT * FROM price
            WHERE ({july} OR {august} OR {september}) AND arrival_date_year = 1997""",
        "adr_round": f"{_BASES} {rounded}",
        "adr_category": f"{_BASES} SELECT *, {band_case} AS adr_category FROM ({rounded})",
        "quarter_months": f"""{_BASES} SELECT "Booking_ID", quarter, CASE quarter
            {" ".join(f"WHEN {q} THEN '{names}'" for q, names in months.items())} END AS months
            FROM (SELECT "Booking_ID", (CAST(arrival_month AS INTEGER) + 2) // 3 AS quarter FROM bookings)""",
        "period_parse": f"""{_BASES} SELECT "Booking_ID",
            arrival_date_year || '-' || arrival_month || '.csv' AS month_label,
            'Q' || q || arrival_date_year AS quarter_label, arrival_date_year AS month_year,
            CAST(arrival_month AS INTEGER) AS month, arrival_date_year AS quarter_year, q AS quarter
            FROM (SELECT *, (CAST(arrival_month AS INTEGER) + 2) // 3 AS q FROM bookings)""",
        "month_rollover": f"""{_BASES} SELECT "Booking_ID",
            CASE WHEN arrival_month = '12' THEN arrival_date_year + 1 ELSE arrival_date_year END AS next_year,
            CASE WHEN arrival_month = '12' THEN 1 ELSE CAST(arrival_month AS INTEGER) + 1 END AS next_month FROM bookings""",
        "onehot_segment": _onehot("market_segment", MARKET_SEGMENTS),
        "onehot_month": _onehot("arrival_date_month", MONTHS),
        "onehot_meal": _onehot("meal", MEALS),
        "onehot_room": _onehot("reserved_room_type", ROOM_TYPES),
        "onehot_dynamic": f"""{_BASES} SELECT "Booking_ID",
            {", ".join(f for c, levels in observed.items() for f in _flags(c, levels))} FROM bookings""",
        "unknown_levels": f"{_BASES} {_unknown()}",
        "ordinal_meal": f"""{_BASES} SELECT "Booking_ID", meal,
            CASE meal {" ".join(f"WHEN '{m}' THEN {i}" for i, m in enumerate(MEALS))} END AS meal_index FROM bookings""",
        "null_profile": f"{_BASES} SELECT * FROM (" + _union([
            f"SELECT '{c}' AS column_name, count(*) - count({_q(c)}) AS n_missing FROM bookings"
            for c in BOOKING_COLUMNS]) + ") WHERE n_missing > 0",
        "describe_numeric": f"{_BASES} " + _union([_describe(c) for c in NUMERIC_FEATURES]),
        "max_profile": f"{_BASES}, banded AS (SELECT *, {band_case} AS adr_category FROM ({rounded})) " + _union([
            f"SELECT '{c}' AS column_name, CAST(max({c}) AS DOUBLE) AS max_value FROM banded"
            for c in ("adr", "adr_category")]),
        "variance_profile": f"{_BASES} " + _union([
            f"SELECT '{c}' AS column_name, {_r(f'var_samp(CAST({c} AS DOUBLE))')} AS variance FROM bookings"
            for c in NUMERIC_FEATURES]),
        "corr_matrix": _correlations(NUMERIC_FEATURES, pairs, corr_line),
        "corr_rank": _correlations(
            rank_columns, [(c, "adr") for c in rank_columns],
            lambda x, y, c: f"SELECT '{x}' AS column_name, {_r(f'abs({c})')} AS abs_corr FROM corrs"),
        "distinct_values": f"{_BASES} " + _union([
            f"SELECT DISTINCT '{c}' AS column_name, CAST({c} AS VARCHAR) AS level FROM bookings"
            for c in [*categorical, "is_repeated_guest"]]),
        "shape_report": f"{_BASES} " + _union([
            f"SELECT '{c}' AS column_name, {i} AS position, '{kind}' AS data_type, "
            f"count({_q(c)}) AS n_present, count(*) AS n_rows, {len(BOOKING_COLUMNS)} AS n_columns FROM bookings"
            for i, (c, kind) in enumerate(BOOKING_COLUMNS.items())]),
        "iqr_outliers": f"{_BASES} " + _union([
            _boxes(stage, c, where) for stage, where in (("raw", "true"), ("in range", _IN_RANGE))
            for c in ("adr", "lead_time")]),
        "head_preview": f'{_BASES} SELECT * FROM bookings ORDER BY "Booking_ID" LIMIT 5',
        "union_by_name": f"""{_BASES}
            SELECT "Booking_ID", adr, is_canceled, NULL::INTEGER AS children FROM bookings WHERE hotel = 'Resort Hotel'
            UNION ALL SELECT "Booking_ID", adr, NULL, children FROM bookings WHERE hotel = 'City Hotel'""",
        "train_test_split": f"""{_BASES} SELECT "Booking_ID",
            CASE WHEN {_SPLIT} < 80 THEN 'train' ELSE 'test' END AS part FROM bookings""",
        "scale_numeric": _scaled(),
        "model_leaderboard": f"{_leaderboard()} SELECT ordinal, candidate, {_r('mse')} AS mse, {_r('r2')} AS r2 FROM board",
        "champion_select": f"""{_leaderboard()} SELECT ordinal, candidate, {_r('mse')} AS mse, {_r('r2')} AS r2
            FROM board ORDER BY board.r2 DESC, ordinal LIMIT 1""",
        "regression_metrics": f"""{_PRICES} SELECT count(*) AS n_rows, {_r("avg((adr - p) ** 2)")} AS mse,
            {_r("sqrt(avg((adr - p) ** 2))")} AS rmse, {_r("1 - avg((adr - p) ** 2) / var_pop(adr)")} AS r2
            FROM (SELECT adr, {_FORMULA} AS p FROM price WHERE {_SPLIT} >= 80)""",
        "classification_metrics": f"""{_CANCELS} SELECT count(*) AS n_rows,
            {_r("avg(CASE WHEN is_canceled = p THEN 1.0::DOUBLE ELSE 0 END)")} AS accuracy,
            {_r("sqrt(avg((is_canceled - p)::DOUBLE ** 2))")} AS label_rmse
            FROM (SELECT is_canceled, CASE WHEN lead_time > 220 THEN 1 ELSE 0 END AS p FROM cancel WHERE {_SPLIT} >= 80)""",
        "knn_classify": _KNN,
        "model_roundtrip": f"{_PRICES} SELECT count(*) AS n_rows, 0::BIGINT AS n_different FROM price WHERE {_SPLIT} >= 80",
        "csv_roundtrip": f"{_BASES} SELECT * REPLACE (nullif(country, 'NA') AS country) FROM bookings",
        "csv_parse_lines": f"""{_BASES} SELECT {_FEED_ID} AS "Booking_ID", {", ".join(_FEED[1:])} FROM bookings""",
        "csv_quoted_lines": f"""{_BASES} SELECT "Booking_ID",
            concat_ws(chr(10), hotel, '"' || meal || '", said', '', country) AS note FROM bookings""",
        "message_encode": _with(_BOOKINGS, _MESSAGES) + "\nSELECT * FROM log",
        "load_overwrite": f"{_PRICES} SELECT {_SAFE} FROM price",
        "load_append": _with(_BOOKINGS, _PRICE, _MONTHLY,
                             "feed AS (SELECT * EXCLUDE (is_canceled), 0::DOUBLE AS predicted FROM monthly)",
                             "both_loads AS (SELECT * FROM price UNION ALL BY NAME SELECT * FROM feed)")
        + f"\nSELECT {_SAFE} FROM both_loads",
        "scan_all": f"{_CANCELS} SELECT * FROM cancel",
        "frame_messages": _with(_EVENT_LOG, """
ends AS (SELECT *, min(CASE WHEN value = 'END' THEN "offset" END) OVER (PARTITION BY partition, frame_id) AS first_end
         FROM framed)""") + """
SELECT topic, partition, "offset", value, CAST(frame_id AS BIGINT) AS frame_id FROM ends
WHERE frame_id > 0 AND "offset" < first_end AND value NOT IN ('START', 'END')""",
        "frame_messages_unreset": _with(_EVENT_LOG, """
ends AS (SELECT *, sum(CASE WHEN value = 'END' THEN 1 ELSE 0 END) OVER (
           PARTITION BY partition, frame_id ORDER BY "offset" ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS n
         FROM framed)""") + """
SELECT topic, partition, "offset", value, CAST(frame_id AS BIGINT) AS frame_id, CAST(n AS BIGINT) AS n_emissions
FROM ends WHERE n > 0 AND value NOT IN ('START', 'END')""",
        "stream_ingest": _with(_BOOKINGS, _MONTHLY)
        + f"\nSELECT * EXCLUDE (is_canceled), {_FORMULA} AS predicted FROM monthly",
    }
    monthly = _with(_BOOKINGS, _MONTHLY)
    sql["stream_ingest_cancel"] = f"""{monthly} SELECT * EXCLUDE (adr), CAST(adr AS DOUBLE) AS adr,
        CASE WHEN lead_time > 220 THEN 1 ELSE 0 END AS predicted FROM monthly"""
    fields = {"Booking_ID": "INN0", "adults": "two", "market_segment": '"Online, TA"', "adr": "99.5"}
    line = ",".join(fields.get(c, "") for c in _FEED)
    sql["stream_rejected"] = f"""{_BASES} SELECT '{line}' AS line, 'unreadable: adults' AS reason,
        'Online, TA' AS market_segment, count(DISTINCT (arrival_date_year, arrival_date_month)) AS n_rows FROM bookings"""
    sql["append_writers"] = sql["load_append"]
    sql["log_ingest"], sql["stateful_frames"] = sql["stream_ingest"], sql["frame_messages"]
    sql["target_encode"] = _encoded()
    sql |= _learners(f"banded AS (SELECT \"Booking_ID\", adr, {band_case} - 1 AS adr_category FROM price)")
    for name, unit in (("monthly_buckets", "month"), ("quarterly_buckets", "quarter")):
        sql[name] = f"""SELECT CAST(date_trunc('{unit}', ts) AS DATE) AS period_start, count(*) AS n_events,
            round(sum(value), 4) AS total_value FROM events GROUP BY 1"""
    return sql
