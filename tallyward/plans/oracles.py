"""DuckDB SQL that says independently what each registered query must give."""

import re

# --- fixed values, written out here once more: what the queries take from the package must not vouch for itself


class S:
    DEVICE_TYPES = ["mobile", "desktop", "tablet"]
    CARD_TYPES = ["credit", "debit", "gift"]
    STATUSES = ["approved", "pending", "declined"]
    LOCATIONS = [
        "California, USA", "New York, USA", "Texas, USA", "Florida, USA", "Illinois, USA",
        "London, UK", "Paris, France", "Berlin, Germany", "Tokyo, Japan", "Sydney, Australia",
    ]
    LOCATION_RISK = {
        "California, USA": 0.2, "New York, USA": 0.2, "Texas, USA": 0.2, "Florida, USA": 0.3, "Illinois, USA": 0.2,
        "London, UK": 0.3, "Paris, France": 0.4, "Berlin, Germany": 0.4, "Tokyo, Japan": 0.5, "Sydney, Australia": 0.5,
        "Unknown": 0.9,
    }
    DEFAULT_RATES = {
        "location": {
            "California, USA": 0.02, "New York, USA": 0.02, "Texas, USA": 0.02, "Florida, USA": 0.03, "Illinois, USA": 0.02,
            "London, UK": 0.03, "Paris, France": 0.04, "Berlin, Germany": 0.04, "Tokyo, Japan": 0.05, "Sydney, Australia": 0.05,
            "Unknown": 0.09,
        },
        "device_type": {"mobile": 0.03, "desktop": 0.01, "tablet": 0.02},
        "card_type": {"credit": 0.025, "debit": 0.01, "gift": 0.05},
    }
    RATE_FEATURES = {"location": "location_fraud_rate", "device_type": "device_fraud_rate", "card_type": "card_fraud_rate"}
    NUMERIC_FEATURES = [
        "amount", "hour_of_day", "day_of_week", "month", "day_of_month", "is_weekend", "is_night",
        "is_vpn", "user_transaction_count", "user_avg_amount", "user_amount_std", "amount_zscore",
        "amount_to_max_ratio", "location_fraud_rate", "device_fraud_rate", "card_fraud_rate",
        "is_unusual_amount", "is_new_user", "is_largest_tx",
    ]
    EXTRA_FEATURES = ["user_min_amount", "user_max_amount", "user_vpn_ratio"]
    LABEL = "is_fraud"
    MODEL_WIDTH = 38
    TTL_SECONDS = 2_592_000
    THRESHOLDS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]


class Q:
    DIGITS = 10
    HISTORY_END = "2024-01-16 00:00:00"
    NOW = "2024-02-01 00:00:00"
    _CSV = [
        "is_vpn", "hour_of_day", "day_of_week", "month", "day_of_month", "is_weekend", "is_night",
        "user_transaction_count", "is_unusual_amount", "is_new_user", "is_largest_tx", "not_a_feature",
        "device_type_mobile", "device_type_desktop", "device_type_tablet", "card_type_credit", "card_type_debit", "card_type_gift",
        "status_approved", "status_pending", "status_declined", "location_california_usa", "location_new_york_usa",
        "location_texas_usa", "location_florida_usa", "location_illinois_usa", "location_london_uk", "location_paris_france",
        "location_berlin_germany", "location_tokyo_japan", "location_sydney_australia",
    ]


def plain_name_of(text: str) -> str:
    return "_".join(re.findall("[a-z0-9]+", text.lower()))


_TX = """tx AS (
 SELECT event_id, concat('T', lpad(cast(event_id AS varchar), 8, '0')) AS transaction_id,
  CASE WHEN event_id % 499 = 7 THEN NULL
       WHEN event_id % 211 = 0 THEN concat('U9', cast(event_id AS varchar))
       WHEN event_id % 199 = 0 THEN concat('U8', cast(cast(floor(event_id / 597.0) AS int) AS varchar))
       ELSE concat('U', cast(10000 + user_id AS varchar)) END AS user_id,
  ts, value AS amount,
  CASE WHEN k % 10 < 4 THEN 'mobile' WHEN k % 10 < 9 THEN 'desktop' ELSE 'tablet' END AS device_type,
  CASE WHEN event_id % 97 = 0 THEN NULL
       WHEN event_id % 89 = 0 THEN 'Oslo, Norway'
       WHEN k >= 90 THEN (CASE k % 5 WHEN 0 THEN 'London, UK' WHEN 1 THEN 'Paris, France'
            WHEN 2 THEN 'Berlin, Germany' WHEN 3 THEN 'Tokyo, Japan' ELSE 'Sydney, Australia' END)
       ELSE (CASE user_id % 5 WHEN 0 THEN 'California, USA' WHEN 1 THEN 'New York, USA'
            WHEN 2 THEN 'Texas, USA' WHEN 3 THEN 'Florida, USA' ELSE 'Illinois, USA' END) END AS location,
  (k % 7 = 0) AS is_vpn,
  CASE WHEN (user_id + k) % 20 < 9 THEN 'credit' WHEN (user_id + k) % 20 < 19 THEN 'debit' ELSE 'gift' END AS card_type,
  CASE event_type WHEN 'error' THEN 'declined' WHEN 'signup' THEN 'pending' ELSE 'approved' END AS status,
  (value > 150 OR (event_type = 'error' AND k >= 50) OR (k >= 90 AND k % 7 = 0)) AS is_fraud
 FROM (SELECT *, cast(regexp_extract(props, '([0-9]+)', 1) AS int) AS k FROM events) e)"""

_ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%SZ')"
_CUT = f"TIMESTAMP '{Q.HISTORY_END}'"
_NOW_EPOCH = f"cast(epoch(TIMESTAMP '{Q.NOW}') AS bigint)"


def _with(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join([_TX, *ctes]) + "\n" + select


def _r(expr: str) -> str:
    return f"(round({expr}, {Q.DIGITS}) + 0.0e0)"


def _int(condition: str) -> str:
    return f"cast(coalesce({condition}, false) AS int)"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _calendar(default: bool = False) -> str:
    parts = {
        "hour_of_day": "cast(hour(ts) AS int)", "day_of_week": "cast(isodow(ts) - 1 AS int)",
        "month": "cast(month(ts) AS int)", "day_of_month": "cast(day(ts) AS int)",
        "is_weekend": "cast(isodow(ts) >= 6 AS int)", "is_night": "cast(hour(ts) < 6 OR hour(ts) >= 22 AS int)",
    }
    missing = {"month": 1, "day_of_month": 1}
    return ", ".join(
        f"coalesce({e}, {missing.get(n, 0)}) AS {n}" if default else f"{e} AS {n}" for n, e in parts.items()
    )


def _stats(name: str, source: str) -> str:
    """Per-user statistics from sums of whole billionths."""
    c = "cast(round(amount * 1000000000) AS HUGEINT)"
    return f"""{name} AS (
 SELECT user_id, n AS user_transaction_count, (cast(s // na AS double) + cast(s % na AS double) / na) / 1000000000 AS user_avg_amount,
  CASE WHEN na > 1 THEN sqrt(cast(q * na - s * s AS double) / (cast(na AS double) * (na - 1))) / 1000000000 ELSE 0.0e0 END
   AS user_amount_std, lo AS user_min_amount, hi AS user_max_amount, vpn AS user_vpn_ratio
 FROM (SELECT user_id, count(transaction_id) AS n, count(amount) AS na,
   sum({c}) AS s, sum({c} * {c}) AS q,
   min(amount) AS lo, max(amount) AS hi, avg(cast(is_vpn AS int)) AS vpn
  FROM {source} WHERE user_id IS NOT NULL GROUP BY user_id) g)"""


_USER_COLUMNS = ["user_transaction_count", "user_avg_amount", "user_amount_std", "user_min_amount",
                 "user_max_amount", "user_vpn_ratio"]

_BEHAVIOUR = """behaviour AS (
 SELECT tx.*, user_transaction_count, user_avg_amount, user_amount_std, user_min_amount, user_max_amount, user_vpn_ratio,
  CASE WHEN user_amount_std > 0 THEN (amount - user_avg_amount) / user_amount_std
       ELSE amount - user_avg_amount END AS amount_zscore,
  CASE WHEN user_max_amount > 0 THEN amount / user_max_amount ELSE 0.0e0 END AS amount_to_max_ratio,
  cast(coalesce(amount > user_avg_amount + 2 * user_amount_std
             OR amount < user_avg_amount - 2 * user_amount_std, false) AS int) AS is_unusual_amount,
  cast(coalesce(user_transaction_count <= 3, false) AS int) AS is_new_user,
  cast(coalesce(amount >= user_max_amount * 0.95e0, false) AS int) AS is_largest_tx
 FROM tx LEFT JOIN user_stats USING (user_id))"""

_ALL_STATS = _stats("user_stats", "tx")


def _rate_ctes(source: str = "tx") -> list[str]:
    made = [
        f"{c}_rates AS (SELECT {c}, avg(cast(is_fraud AS int)) AS {t} FROM {source} WHERE {c} IS NOT NULL GROUP BY {c})"
        for c, t in S.RATE_FEATURES.items()
    ]
    return [*made, f"overall AS (SELECT avg(cast(is_fraud AS int)) AS rate FROM {source})"]


def _rate_joins(left: str) -> str:
    return (
        f"FROM {left} LEFT JOIN location_rates USING (location) LEFT JOIN device_type_rates USING (device_type) "
        "LEFT JOIN card_type_rates USING (card_type) CROSS JOIN overall"
    )


_RATES = [
    "coalesce(location_fraud_rate, overall.rate) AS location_fraud_rate", "device_fraud_rate", "card_fraud_rate",
]

_FITTED_LOCATIONS = sorted([*S.LOCATIONS, "Oslo, Norway"])


def _one_hot(values: dict[str, list[str]]) -> list[str]:
    return [
        f"{_int(f'{c} = {_text(v)}')} AS {c}_{plain_name_of(v)}" for c, vs in values.items() for v in vs
    ]


_FITTED = {
    "device_type": sorted(S.DEVICE_TYPES), "card_type": sorted(S.CARD_TYPES), "status": sorted(S.STATUSES),
    "location": _FITTED_LOCATIONS,
}
_FIXED = {"device_type": S.DEVICE_TYPES, "card_type": S.CARD_TYPES, "status": S.STATUSES, "location": S.LOCATIONS}
_ONE_HOT_NAMES = [f"{c}_{plain_name_of(v)}" for c, vs in _FITTED.items() for v in vs]


def _case(column: str, table: dict[str, object], other: str) -> str:
    whens = " ".join(f"WHEN {_text(k)} THEN {float(v)!r}e0" for k, v in table.items())
    return f"CASE {column} {whens} ELSE {other} END"


_FRAME = ["frame AS (SELECT behaviour.* EXCLUDE (is_vpn), cast(is_vpn AS int) AS is_vpn, "
          f"{_calendar()}, {', '.join(_RATES)}, {', '.join(_one_hot(_FITTED))} {_rate_joins('behaviour')})"]
_FRAME_CTES = [_ALL_STATS, _BEHAVIOUR, *_rate_ctes(), *_FRAME]
_MODEL_NAMES = [*S.NUMERIC_FEATURES, *_ONE_HOT_NAMES]

_DOUBLES = {
    "amount", "user_avg_amount", "user_amount_std", "user_min_amount", "user_max_amount", "user_vpn_ratio",
    "amount_zscore", "amount_to_max_ratio", "location_fraud_rate", "device_fraud_rate", "card_fraud_rate",
}


def _show(names: list[str]) -> str:
    return ", ".join(f"{_r(n)} AS {n}" if n in _DOUBLES else n for n in names)


_RISK = _case("coalesce(location, 'Unknown')", S.LOCATION_RISK, "0.7e0")
_SCORED = f"""scored AS (
 SELECT *, least(1.0e0, (amount / 1000) * 0.3e0 + (CASE WHEN is_vpn THEN 1 ELSE 0 END) * 0.2e0
   + ({_RISK}) * 0.3e0 + (CASE WHEN status = 'declined' THEN 1 ELSE 0 END) * 0.2e0) AS score FROM tx)"""
_FLAGGED = "flagged AS (SELECT *, score >= 0.5e0 AS flagged FROM scored)"
_CM = """cm AS (SELECT count(*) FILTER (NOT is_fraud AND NOT flagged) AS tn, count(*) FILTER (NOT is_fraud AND flagged) AS fp,
 count(*) FILTER (is_fraud AND NOT flagged) AS fn, count(*) FILTER (is_fraud AND flagged) AS tp FROM flagged)"""


def _share(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN ({part}) / cast({whole} AS double) ELSE 0.0e0 END"


def _report() -> str:
    def metrics(hit, missed, wrong):
        p, r = _share(hit, f"({hit} + {wrong})"), _share(hit, f"({hit} + {missed})")
        return {"precision": p, "recall": r,
                "f1-score": f"coalesce(2 * ({p}) * ({r}) / nullif(({p}) + ({r}), 0), 0.0e0)",
                "support": f"cast({hit} + {missed} AS double)"}

    classes = {"0": metrics("tn", "fp", "fn"), "1": metrics("tp", "fn", "fp")}
    total = "(tn + fp + fn + tp)"
    lines = [(k, m, e) for k, ms in classes.items() for m, e in ms.items()]
    lines.append(("accuracy", "accuracy", _share("tn + tp", total)))
    for m in ("precision", "recall", "f1-score"):
        a, b = classes["0"][m], classes["1"][m]
        lines.append(("macro avg", m, f"(({a}) + ({b})) / 2"))
        lines.append(("weighted avg", m, f"(({a}) * (tn + fp) + ({b}) * (fn + tp)) / cast({total} AS double)"))
    lines += [(k, "support", f"cast({total} AS double)") for k in ("macro avg", "weighted avg")]
    return "\nUNION ALL ".join(
        f"SELECT '{k}' AS label, '{m}' AS metric, {_r(e)} AS value FROM cm" for k, m, e in lines
    )


_SWEEP = f"""sweep AS (
 SELECT threshold, {_share('tp', '(tp + fn)')} AS detection_rate, {_share('fp', '(fp + tn)')} AS false_alarm_rate,
  {_share('tp', '(tp + fp)')} AS precision, tp AS true_positives, fn AS false_negatives, fp AS false_positives,
  tn AS true_negatives
 FROM (SELECT threshold, count(*) FILTER (is_fraud AND score >= threshold) AS tp,
   count(*) FILTER (is_fraud AND score < threshold) AS fn, count(*) FILTER (NOT is_fraud AND score >= threshold) AS fp,
   count(*) FILTER (NOT is_fraud AND score < threshold) AS tn
  FROM scored CROSS JOIN (VALUES {', '.join(f'({t}e0)' for t in S.THRESHOLDS)}) t(threshold) GROUP BY threshold) c)"""
_SWEEP_SHOWN = """SELECT threshold, round(detection_rate, 10) AS detection_rate,
 round(false_alarm_rate, 10) AS false_alarm_rate, round(precision, 10) AS precision, true_positives, false_negatives,
 false_positives, true_negatives FROM sweep"""

_SPLIT = """ranked AS (SELECT *,
  row_number() OVER (PARTITION BY is_fraud ORDER BY md5(concat(transaction_id, ':42')), transaction_id) AS rn,
  count(*) OVER (PARTITION BY is_fraud) AS cn, count(*) OVER () AS n FROM tx),
 wanted AS (SELECT is_fraud, cn, ceil(n * 0.2e0) AS nt, ceil(n * 0.2e0) * cn / n AS want
  FROM ranked GROUP BY is_fraud, cn, n),
 quota AS (SELECT is_fraud, floor(want) + CASE WHEN row_number() OVER (ORDER BY want - floor(want) DESC, is_fraud)
  <= nt - sum(floor(want)) OVER () THEN 1 ELSE 0 END AS take FROM wanted),
 parted AS (SELECT ranked.* EXCLUDE (rn, cn, n), CASE WHEN rn <= take THEN 'test' ELSE 'train' END AS split
  FROM ranked JOIN quota USING (is_fraud))"""


def _corr(x: str, y: str) -> str:
    both = f"{x} IS NOT NULL AND {y} IS NOT NULL"
    return (f"covar_pop(cast({y} AS double), cast({x} AS double)) / nullif(stddev_pop(CASE WHEN {both} THEN {x} END)"
            f" * stddev_pop(CASE WHEN {both} THEN {y} END), 0)")


_CORR_NAMES = [S.LABEL, *S.NUMERIC_FEATURES, "user_min_amount", "user_max_amount", "user_vpn_ratio", *_ONE_HOT_NAMES]
_CORR_FRAME = "numbers AS (SELECT * EXCLUDE (is_fraud), cast(is_fraud AS int) AS is_fraud FROM frame)"
_CORR_WITH_LABEL = "with_label AS (" + " UNION ALL ".join(
    f"SELECT '{n}' AS feature, {_corr(n, S.LABEL)} AS corr FROM numbers" for n in _CORR_NAMES
) + ")"


def _corr_matrix() -> str:
    """Long form of the chosen columns, joined with itself by row and position."""
    cells = " UNION ALL ".join(
        f"SELECT event_id, '{n}' AS feature, cast({n} AS double) AS v FROM numbers" for n in _CORR_NAMES
    )
    return _with(
        *_FRAME_CTES, _CORR_FRAME, _CORR_WITH_LABEL,
        "best AS (SELECT feature FROM with_label ORDER BY corr DESC NULLS LAST, feature LIMIT 15)",
        f"cells AS (SELECT * FROM ({cells}) c SEMI JOIN best USING (feature))",
        select=f"""SELECT a.feature AS feature_x, b.feature AS feature_y,
 {_r("covar_pop(a.v, b.v) / nullif(stddev_pop(a.v) * stddev_pop(b.v), 0)")} AS corr
FROM cells a JOIN cells b ON a.event_id = b.event_id AND a.v IS NOT NULL AND b.v IS NOT NULL GROUP BY 1, 2""",
    )


# --- extractor -------------------------------------------------------------

_EARLIER = f"earlier AS (SELECT * FROM tx WHERE ts < {_CUT})"
_DEFAULT_LOCATION = _case("coalesce(location, 'Unknown')", S.DEFAULT_RATES["location"], "0.05e0")
_DEFAULT_DEVICE = _case("coalesce(device_type, 'unknown')", S.DEFAULT_RATES["device_type"], "0.02e0")
_DEFAULT_CARD = _case("coalesce(card_type, 'unknown')", S.DEFAULT_RATES["card_type"], "0.02e0")


def _extracted(source: str = "tx") -> str:
    def known(expr: str, other: str) -> str:
        return f"CASE WHEN user_transaction_count IS NULL THEN {other} ELSE {expr} END"

    z = "CASE WHEN user_amount_std > 0 THEN (amount - user_avg_amount) / user_amount_std ELSE 0.0e0 END"
    return f"""extracted AS (SELECT {source}.* EXCLUDE (is_vpn), cast(is_vpn AS int) AS is_vpn, {_calendar()},
 coalesce(user_transaction_count, 1) AS user_transaction_count, coalesce(user_avg_amount, 0) AS user_avg_amount,
 coalesce(user_amount_std, 1) AS user_amount_std, coalesce(user_min_amount, 0) AS user_min_amount,
 coalesce(user_max_amount, 0) AS user_max_amount, coalesce(user_vpn_ratio, 0) AS user_vpn_ratio,
 {known(z, '0.0e0')} AS amount_zscore,
 {known('CASE WHEN user_max_amount > 0 THEN amount / user_max_amount ELSE 1.0e0 END', '1.0e0')} AS amount_to_max_ratio,
 {known(f'cast(user_amount_std > 0 AND abs({z}) > 2 AS int)', '0')} AS is_unusual_amount,
 {known('cast(user_transaction_count <= 3 AS int)', '1')} AS is_new_user,
 {known('cast(amount >= user_max_amount * 0.95e0 AS int)', '1')} AS is_largest_tx,
 {_DEFAULT_LOCATION} AS location_fraud_rate, {_DEFAULT_DEVICE} AS device_fraud_rate, {_DEFAULT_CARD} AS card_fraud_rate
FROM {source} LEFT JOIN user_stats USING (user_id))"""


def _csv() -> str:
    one_hot = {e.rsplit(" AS ", 1)[1]: e.rsplit(" AS ", 1)[0] for e in _one_hot(_FIXED)}
    cells = ["'0'" if n == "not_a_feature" else f"cast({one_hot.get(n, n)} AS varchar)" for n in Q._CSV]
    pad = S.MODEL_WIDTH - len(Q._CSV)
    padded = f"csv || repeat(',0', {pad})" if pad >= 0 else f"array_to_string(string_split(csv, ',')[1:{S.MODEL_WIDTH}], ',')"
    return _with(
        _EARLIER, _stats("user_stats", "earlier"), _extracted(),
        f"lines AS (SELECT transaction_id, concat_ws(',', {', '.join(cells)}) AS csv FROM extracted)",
        select=f"""SELECT transaction_id, csv, {padded} AS padded,
 array_to_string(string_split(csv, ',')[1:8], ',') AS cut FROM lines""",
    )


# --- store and stream ------------------------------------------------------

# A row decided without a model: the rule score, flagged above 0.7.
_PREDICTED = f"""predicted AS (SELECT * EXCLUDE (is_fraud, score), score AS fraud_probability, score > 0.7e0 AS is_fraud,
 {_NOW_EPOCH} + {S.TTL_SECONDS} AS ttl FROM scored)"""
_FACTORS = ["'Amount: $' || printf('%.2f', amount)", "'Location: ' || coalesce(location, 'Unknown')",
            "'Device: ' || device_type", "'VPN: ' || CASE WHEN is_vpn THEN 'True' ELSE 'False' END",
            "'Card Type: ' || card_type"]
_FACTOR_TEXT = f"concat_ws(' | ', {', '.join(_FACTORS)})"
_VERSIONS = """versions AS (
 SELECT transaction_id, user_id, amount, 1 AS version FROM tx
 UNION ALL SELECT transaction_id, user_id, amount * 2.0e0, 2 FROM tx WHERE status = 'declined'
 UNION ALL SELECT transaction_id, user_id, amount * 4.0e0, 3 FROM tx WHERE is_vpn)"""
_LATEST = """SELECT transaction_id, user_id, round(amount, 10) AS amount, version FROM (
 SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY version DESC) AS place FROM versions) v WHERE place = 1"""

_ROUTE = """CASE WHEN event_id % 59 = 0 THEN 'invalid' WHEN event_id % 53 = 0 THEN 'direct'
 WHEN event_id % 157 = 0 THEN 'invalid' ELSE 'records' END"""
_REASON = f"""CASE ({_ROUTE}) WHEN 'invalid' THEN 'invalid_envelope'
 WHEN 'direct' THEN CASE WHEN event_id % 3 = 0 THEN 'bad_json' WHEN event_id % 5 = 0 THEN 'bad_amount' ELSE 'valid' END ELSE
 CASE WHEN event_id % 101 = 0 THEN 'bad_base64' WHEN event_id % 103 = 0 THEN 'bad_json'
      WHEN event_id % 107 = 0 THEN 'no_transaction_id' WHEN event_id % 139 = 0 THEN 'bad_json'
      WHEN event_id % 149 = 0 OR event_id % 151 = 0 THEN 'extra_data'
      WHEN event_id % 109 = 0 OR event_id % 127 = 0 OR event_id % 131 = 0 OR event_id % 137 = 0 THEN 'bad_amount'
      ELSE 'valid' END END"""
_WIRE = f"wire AS (SELECT *, {_ROUTE} AS route, {_REASON} AS reason FROM tx)"
_READ = "read_back AS (SELECT * FROM predicted WHERE event_id IN (SELECT event_id FROM wire WHERE reason = 'valid'))"


def oracle_sql() -> dict[str, str]:
    stats_shown = "SELECT user_id, " + _show(_USER_COLUMNS) + " FROM user_stats"
    behaviour_names = ["amount", "user_transaction_count", "user_avg_amount", "user_amount_std", "user_max_amount",
                       "user_vpn_ratio", "amount_zscore", "amount_to_max_ratio", "is_unusual_amount", "is_new_user",
                       "is_largest_tx"]
    rates_shown = ", ".join(
        f"{_r(e.split(' AS ')[0])} AS {t}" for e, t in zip(_RATES, S.RATE_FEATURES.values(), strict=True)
    )
    time_text = f"""CASE WHEN event_id % 131 = 0 THEN NULL WHEN event_id % 137 = 0 THEN NULL
 WHEN event_id % 139 = 0 THEN NULL ELSE date_trunc('second', ts) END"""
    manifest = (
        "numeric_part AS (SELECT * FROM (VALUES " + ", ".join(
            f"({i}, '{n}')" for i, n in enumerate(S.NUMERIC_FEATURES, 1)) + ") m(position, feature))",
        "vocabulary AS (" + " UNION ".join(
            f"SELECT {i} AS block, '{c}' AS name, {c} AS value FROM tx WHERE {c} IS NOT NULL"
            for i, c in enumerate(("device_type", "card_type", "status", "location"))) + ")",
        "one_hot_part AS (SELECT *, row_number() OVER (ORDER BY block, value) AS place FROM vocabulary)",
    )
    features = f"""SELECT cast(position AS int) AS position, feature, 'numeric' AS kind FROM numeric_part
UNION ALL SELECT cast({len(S.NUMERIC_FEATURES)} + place AS int), name || '_' || regexp_replace(lower(value), '[^a-z0-9]+', '_', 'g'),
 'categorical' FROM one_hot_part"""
    return {
        "load_profile": _with(select=f"SELECT count(*) AS rows, {_r('avg(cast(is_fraud AS int)) * 100')} AS fraud_percent FROM tx"),
        "time_features": _with(select=f"SELECT transaction_id, {_calendar()} FROM tx"),
        "time_features_text": _with(
            f"read_text AS (SELECT transaction_id, {time_text} AS ts FROM tx)",
            select=f"SELECT transaction_id, ts IS NOT NULL AS readable, {_calendar(default=True)} FROM read_text",
        ),
        "batch_time_text": _with(select="SELECT transaction_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS parsed FROM tx"),
        "user_stats": _with(_ALL_STATS, select=stats_shown),
        "user_stats_incremental": _with(_ALL_STATS, select=stats_shown),
        "user_stats_wide": _with(
            """wide AS (SELECT concat('U', cast(event_id % 3 AS varchar)) AS user_id, CASE event_id % 3 WHEN 0 THEN amount * 1e11
  WHEN 1 THEN round(amount / 1e4, 7) ELSE 9e8 END AS x FROM tx)""",
            select=f"""SELECT user_id, count(*) AS user_transaction_count, {_r('avg(x) / max(x)')} AS avg_to_max,
 {_r('stddev_samp(x) / avg(x)')} AS std_to_avg FROM wide GROUP BY user_id"""),
        "feat_user_behavior": _with(
            _ALL_STATS, _BEHAVIOUR, select=f"SELECT transaction_id, user_id, {_show(behaviour_names)} FROM behaviour"
        ),
        "category_fraud_rates": _with(select=" UNION ALL ".join(
            f"SELECT '{c}' AS category, {c} AS value, count(*) AS rows, {_r('avg(cast(is_fraud AS int))')} AS rate "
            f"FROM tx WHERE {c} IS NOT NULL GROUP BY {c}" for c in S.RATE_FEATURES
        )),
        "rate_encoded": _with(*_rate_ctes(), select=f"SELECT transaction_id, {rates_shown} {_rate_joins('tx')}"),
        "rate_encoded_train_only": _with(
            _SPLIT, "train_rows AS (SELECT * FROM parted WHERE split = 'train')", *_rate_ctes("train_rows"),
            select=f"SELECT transaction_id, split, {rates_shown} {_rate_joins('parted')}",
        ),
        "rate_encoded_folds": _with(
            _SPLIT, """dealt AS (SELECT *, CASE WHEN split = 'train' THEN
  cast(('0x' || substr(md5(transaction_id || ':fold:42'), 1, 8))::BIGINT % 5 AS int) ELSE -1 END AS fold FROM parted)""",
            "folds AS (SELECT unnest([-1, 0, 1, 2, 3, 4]) AS fold)",
            """priors AS (SELECT f.fold, avg(cast(is_fraud AS int)) AS prior FROM folds f JOIN dealt d ON d.fold >= 0 AND d.fold <> f.fold GROUP BY f.fold)""",
            *[f"""{c}_folds AS (SELECT f.fold, {c}, (sum(CASE WHEN d.fold <> f.fold THEN cast(is_fraud AS int) ELSE 0 END) + 20 * any_value(prior))
  / (count(*) FILTER (d.fold <> f.fold) + 20) AS {t} FROM priors f JOIN dealt d ON d.fold >= 0 WHERE {c} IS NOT NULL GROUP BY f.fold, {c})"""
              for c, t in S.RATE_FEATURES.items()],
            select=f"""SELECT transaction_id, split, fold, {_r('coalesce(location_fraud_rate, prior)')} AS location_fraud_rate,
 {_r('coalesce(device_fraud_rate, CASE WHEN device_type IS NOT NULL THEN prior END)')} AS device_fraud_rate,
 {_r('coalesce(card_fraud_rate, CASE WHEN card_type IS NOT NULL THEN prior END)')} AS card_fraud_rate
FROM dealt LEFT JOIN priors USING (fold) LEFT JOIN location_folds USING (fold, location) LEFT JOIN device_type_folds USING (fold, device_type)
 LEFT JOIN card_type_folds USING (fold, card_type)"""),
        "rate_encoded_defaults": _with(select=f"""SELECT transaction_id, {_DEFAULT_LOCATION} AS location_fraud_rate,
 {_DEFAULT_DEVICE} AS device_fraud_rate, {_DEFAULT_CARD} AS card_fraud_rate FROM tx"""),
        "one_hot_fitted": _with(select=f"SELECT transaction_id, {', '.join(_one_hot(_FITTED))} FROM tx"),
        "one_hot_fixed": _with(select=f"""SELECT transaction_id, lower(replace(location, ', ', '_')) AS location_short_name,
 regexp_replace(lower(location), '[^a-z0-9]+', '_', 'g') AS location_plain_name, {', '.join(_one_hot(_FIXED))} FROM tx"""),
        "feature_frame": _with(
            *_FRAME_CTES, select=f"SELECT transaction_id, cast(is_fraud AS int) AS is_fraud, {_show(_MODEL_NAMES)} FROM frame"
        ),
        "location_risk": _with(select=f"SELECT transaction_id, {_RISK} AS location_risk FROM tx"),
        "rule_risk_score": _with(_SCORED, select=f"SELECT transaction_id, {_r('score')} AS risk_score FROM scored"),
        "clamped_amount": _with(select="SELECT transaction_id, least(greatest(amount, 5.0e0), 500.0e0) AS clamped FROM tx"),
        "device_code": _with(select="""SELECT transaction_id, cast(CASE device_type WHEN 'mobile' THEN 0
 WHEN 'desktop' THEN 1 WHEN 'tablet' THEN 2 ELSE 3 END AS int) AS device_code FROM tx"""),
        "extractor_features": _with(
            _EARLIER, _stats("user_stats", "earlier"), _extracted(),
            select=f"SELECT transaction_id, {_show([*S.NUMERIC_FEATURES, *S.EXTRA_FEATURES])} FROM extracted",
        ),
        "feature_csv": _csv(),
        "running_user_profile": _with(select=f"""SELECT transaction_id, user_id, count(*) OVER w AS running_count,
 {_r("cast(sum(cast(round(amount * 1000000000) AS HUGEINT)) OVER w AS double) / count(*) OVER w / 1000000000")} AS running_avg FROM tx
WINDOW w AS (PARTITION BY user_id ORDER BY ts, transaction_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""),
        "flags_at_threshold": _with(_SCORED, select=f"""SELECT transaction_id, is_fraud, {_r('score')} AS score,
 score >= 0.5e0 AS flag_batch, score > 0.5e0 AS flag_stream, (score >= 0.5e0) = is_fraud AS correct FROM scored"""),
        "confusion_matrix": _with(_SCORED, _FLAGGED, _CM, select="SELECT tn, fp, fn, tp FROM cm"),
        "classification_report": _with(_SCORED, _FLAGGED, _CM, select=_report()),
        "business_metrics": _with(_SCORED, _FLAGGED, _CM, select=f"""SELECT {_r(_share('tp', '(tp + fn)'))} AS detection_rate,
 {_r(_share('fp', '(fp + tn)'))} AS false_alarm_rate, {_r(_share('tp', '(tp + fp)'))} AS precision,
 tp AS fraud_cases_detected, fn AS fraud_cases_missed, fp AS false_alarms,
 printf('%.2f', round({_share('tp', '(tp + fn)')}, 4) * 100) || '%' AS detection_text FROM cm"""),
        "positive_rates": _with(_SCORED, _FLAGGED, _CM, select=f"""SELECT tn + fp + fn + tp AS test_size,
 {_r(_share('fp + tp', '(tn + fp + fn + tp)'))} AS positive_rate, {_r(_share('tp', '(tp + fn)'))} AS true_positive_rate FROM cm"""),
        "roc_auc": _with(
            _SCORED,
            "by_score AS (SELECT score, count(*) FILTER (is_fraud) AS pos, count(*) FILTER (NOT is_fraud) AS neg FROM scored GROUP BY score)",
            "cum AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM by_score)",
            select=f"""SELECT {_r('sum(pos * (below + neg / 2e0)) / (cast(sum(pos) AS double) * cast(sum(neg) AS double))')} AS roc_auc,
 cast(sum(pos) AS bigint) AS positives, cast(sum(neg) AS bigint) AS negatives FROM cum""",
        ),
        "roc_points": _with(
            _SCORED,
            "by_score AS (SELECT score, count(*) FILTER (is_fraud) AS pos, count(*) FILTER (NOT is_fraud) AS neg FROM scored GROUP BY score)",
            """curve AS (SELECT score, pos, neg, row_number() OVER w AS place, sum(pos) OVER w AS tps, sum(neg) OVER w AS fps,
  lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg, sum(pos) OVER () AS p, sum(neg) OVER () AS n
  FROM by_score WINDOW w AS (ORDER BY score DESC))""",
            select=f"""SELECT cast('Infinity' AS double) AS threshold, 0.0e0 AS fpr, 0.0e0 AS tpr
UNION ALL SELECT {_r('score')}, {_r('fps / cast(n AS double)')}, {_r('tps / cast(p AS double)')} FROM curve
WHERE place = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg""",
        ),
        "threshold_sweep": _with(_SCORED, _SWEEP, select=_SWEEP_SHOWN),
        "recommended_threshold": _with(
            _SCORED, _SWEEP,
            select=_SWEEP_SHOWN + " WHERE sweep.detection_rate >= 0.8e0 ORDER BY sweep.false_alarm_rate, threshold LIMIT 1",
        ),
        "first5_per_class": _with(_SCORED, _FLAGGED, select=f"""SELECT transaction_id, is_fraud, cast(place AS int) AS place,
 {_r('score')} AS score, {_r('amount')} AS amount, is_vpn, flagged = is_fraud AS correct FROM (
 SELECT *, row_number() OVER (PARTITION BY is_fraud ORDER BY transaction_id) AS place FROM flagged) f WHERE place <= 5"""),
        "correlation_with_label": _with(
            *_FRAME_CTES, _CORR_FRAME, _CORR_WITH_LABEL, select=f"SELECT feature, {_r('corr')} AS corr FROM with_label"
        ),
        "correlation_top15": _corr_matrix(),
        "stratified_split": _with(_SPLIT, select="SELECT transaction_id, is_fraud, split FROM parted"),
        "split_summary": _with(_SPLIT, select=f"""SELECT split, count(*) AS rows,
 {_r('avg(cast(is_fraud AS int))')} AS fraud_ratio FROM parted GROUP BY split"""),
        "validation_split": _with(
            _SPLIT,
            """train_ranked AS (SELECT *, row_number() OVER (ORDER BY md5(concat(transaction_id, ':validation:42')), transaction_id) AS rn,
  count(*) OVER () AS n FROM parted WHERE split = 'train')""",
            select="""SELECT transaction_id, is_fraud, split FROM parted WHERE split = 'test'
UNION ALL SELECT transaction_id, is_fraud, CASE WHEN rn <= ceil(n * 0.2e0) THEN 'validation' ELSE 'train' END FROM train_ranked""",
        ),
        "class_ratio_sample": _with(select="""SELECT transaction_id, is_fraud FROM (
 SELECT *, row_number() OVER (PARTITION BY is_fraud ORDER BY md5(concat(transaction_id, ':sample:42')), transaction_id) AS rn FROM tx) r
WHERE rn <= CASE WHEN is_fraud THEN 100 ELSE 400 END"""),
        "standard_scaled": _with(
            _SPLIT, *_FRAME_CTES,
            "marked AS (SELECT frame.*, parted.split FROM frame JOIN parted USING (transaction_id))",
            "moments AS (SELECT " + ", ".join(
                f"avg({n}) AS m_{n}, coalesce(nullif(stddev_pop({n}), 0), 1) AS s_{n}" for n in S.NUMERIC_FEATURES
            ) + " FROM marked WHERE split = 'train')",
            select="SELECT transaction_id, split, " + ", ".join(
                f"(round(({n} - m_{n}) / s_{n}, 6) + 0.0e0) AS {n}" for n in S.NUMERIC_FEATURES
            ) + " FROM marked CROSS JOIN moments",
        ),
        "sorted_timeline": _with(select=f"SELECT transaction_id, {_ISO} AS timestamp, user_id, amount FROM tx ORDER BY ts, transaction_id"),
        "head_n": _with(select="SELECT transaction_id, user_id, amount, status FROM tx ORDER BY transaction_id LIMIT 1000"),
        "alerts": _with(_SCORED, select=f"""SELECT 'FRAUD ALERT: Transaction ' || transaction_id AS subject,
 transaction_id, user_id, {_r('amount')} AS amount, {_ISO} AS timestamp, {_r('score')} AS fraud_probability,
 {_FACTOR_TEXT} AS risk_factors, 'FRAUD ALERT: Transaction ' || transaction_id AS message_subject,
 {_r('amount')} AS message_amount, {_FACTOR_TEXT} AS message_risk_factors FROM scored WHERE score > 0.5e0"""),
        "merged_store": _with(_SCORED, _PREDICTED, select=f"""SELECT transaction_id, user_id,
 cast(cast(cast(amount AS varchar) AS decimal(38,18)) AS varchar) AS amount_exact, status,
 {_r('fraud_probability')} AS fraud_probability, is_fraud, '{Q.NOW.replace(" ", "T")}' AS prediction_timestamp, ttl,
 strftime(to_timestamp(ttl) AT TIME ZONE 'UTC', '%Y-%m-%d') AS expiry_date, 'model not available' AS error FROM predicted"""),
        "appended_batches": _with(_VERSIONS, select="SELECT transaction_id, user_id, round(amount, 10) AS amount, version FROM versions"),
        "latest_by_key": _with(_VERSIONS, select=_LATEST),
        "upserted": _with(_VERSIONS, select=_LATEST),
        "live_rows": _with(select=f"""SELECT transaction_id, cast(floor(epoch(ts)) AS bigint) + {S.TTL_SECONDS} AS ttl FROM tx
WHERE cast(floor(epoch(ts)) AS bigint) + {S.TTL_SECONDS} > {_NOW_EPOCH}"""),
        "rows_of_user": _with(_SCORED, _PREDICTED, select=f"""SELECT transaction_id, user_id, {_r('amount')} AS amount,
 {_r('fraud_probability')} AS fraud_probability, is_fraud FROM predicted WHERE user_id = (SELECT min(user_id) FROM tx)"""),
        "route_envelopes": _with(_WIRE, select="""SELECT transaction_id AS line_id, route,
 CASE WHEN route = 'records' THEN 1 ELSE 0 END AS records FROM wire"""),
        "decode_reject": _with(_WIRE, select="""SELECT
 CASE WHEN reason IN ('valid', 'bad_amount') THEN transaction_id END AS transaction_id,
 CASE WHEN reason IN ('valid', 'bad_amount', 'no_transaction_id') THEN user_id END AS user_id,
 CASE WHEN reason IN ('valid', 'no_transaction_id') THEN amount END AS amount,
 CASE WHEN reason IN ('valid', 'bad_amount', 'no_transaction_id') THEN is_vpn END AS is_vpn, route, reason,
 CASE WHEN reason <> 'valid' THEN reason IN ('bad_json', 'bad_amount', 'extra_data') END AS raw_names_id FROM wire"""),
        "stream_scored": _with(
            _SCORED, _PREDICTED, _WIRE, _READ, _EARLIER, _stats("user_stats", "earlier"), _extracted("read_back"),
            select=f"""SELECT transaction_id, user_id, {_r('amount')} AS amount, is_vpn = 1 AS is_vpn,
 {_r('fraud_probability')} AS fraud_probability, is_fraud, ttl, hour_of_day, {_r('amount_zscore')} AS amount_zscore,
 location_fraud_rate FROM extracted""",
        ),
        "stream_learned_scored": _with(
            "sent AS (SELECT * FROM tx WHERE event_id % 3 > 0)",
            f"first_part AS (SELECT * FROM sent WHERE ts < {_CUT})", f"second_part AS (SELECT * FROM sent WHERE ts >= {_CUT})",
            "late_part AS (SELECT * FROM second_part UNION ALL SELECT * REPLACE (amount * 2 AS amount) FROM first_part WHERE event_id % 7 = 0)",
            "once_part AS (SELECT * FROM first_part WHERE event_id % 7 > 0)",
            "base AS (SELECT * FROM tx WHERE event_id % 3 = 0)", "base_and_first AS (FROM base UNION ALL FROM first_part)",
            _stats("first_stats", "base"), _stats("second_stats", "base_and_first"),
            select=" UNION ALL ".join(
                f"""SELECT transaction_id, {_r('amount')} AS amount, coalesce(user_transaction_count, 1) AS user_transaction_count,
 {_r('coalesce(user_avg_amount, 0)')} AS user_avg_amount,
 {_r('CASE WHEN user_amount_std > 0 THEN (amount - user_avg_amount) / user_amount_std ELSE 0.0e0 END')} AS amount_zscore
 FROM {part} LEFT JOIN {side} USING (user_id)""" for part, side in (("once_part", "first_stats"), ("late_part", "second_stats")))),
        "stream_test_result": _with(_SCORED, _PREDICTED, select=f"""SELECT count(*) AS sent, count(*) AS processed,
 count(*) FILTER (is_fraud) AS fraud_detected, {_r('avg(fraud_probability)')} AS avg_fraud_probability, true AS complete_enough
 FROM predicted"""),
        "stream_summary": _with(
            _SCORED, _PREDICTED, _WIRE, _READ,
            select="""SELECT 'processed' AS what, count(*) AS n FROM read_back
UNION ALL SELECT 'fraud', count(*) FROM read_back WHERE is_fraud
UNION ALL SELECT 'alerts', count(*) FROM read_back WHERE is_fraud
UNION ALL SELECT 'rejects', count(*) FROM wire WHERE reason <> 'valid'""",
        ),
        "stream_profile": _with(_ALL_STATS, select=stats_shown),
        "found_ids": _with(_SCORED, _PREDICTED, _WIRE, _READ, select=f"""SELECT transaction_id,
 {_r('fraud_probability')} AS fraud_probability, is_fraud FROM read_back"""),
        "missing_ids": _with(_WIRE, select="SELECT transaction_id FROM wire WHERE reason <> 'valid'"),
        "round_trip_summary": _with(_SCORED, _PREDICTED, _WIRE, _READ, select=f"""SELECT (SELECT count(*) FROM tx) AS sent,
 count(*) AS processed, count(*) FILTER (is_fraud) AS fraud_detected, {_r('avg(fraud_probability)')} AS avg_fraud_probability,
 count(*) / cast((SELECT count(*) FROM tx) AS double) >= 0.5e0 AS complete_enough FROM read_back"""),
        "json_round_trip": _with(select=f"""SELECT transaction_id, user_id, {_ISO} AS timestamp, {_r('amount')} AS amount,
 device_type, location, is_vpn, card_type, status, is_fraud, cast(hour(ts) AS int) AS hour_of_day FROM tx"""),
        "history_document_round_trip": _with(
            """marked AS (SELECT *, CASE WHEN event_id % 61 = 0 OR event_id % 67 = 0 THEN 'bad_json' WHEN event_id % 71 = 0 THEN 'no_label'
  WHEN event_id % 73 = 0 THEN 'bad_time' WHEN event_id % 35 = 0 THEN 'extra_data' END AS reason FROM tx)""",
            select=f"""SELECT transaction_id, CASE WHEN reason IS NULL THEN user_id END AS user_id,
 CASE WHEN reason IS NULL THEN {_ISO} END AS timestamp, CASE WHEN reason IS NULL THEN {_r('amount')} END AS amount,
 CASE WHEN reason IS NULL THEN is_fraud END AS is_fraud, reason FROM marked"""),
        "publish_round_trip": _with(select=f"""SELECT transaction_id AS key, transaction_id, user_id, {_ISO} AS timestamp,
 {_r('amount')} AS amount, device_type, location, is_vpn, card_type, status FROM tx"""),
        "log_replay": _with(select=f"""SELECT transaction_id, user_id, {_ISO} AS timestamp, {_r('amount')} AS amount, is_vpn,
 'valid' AS reason FROM tx"""),
        "libsvm_round_trip": _with(*_FRAME_CTES, select="SELECT cast(is_fraud AS int) AS label, " + ", ".join(
            f"{_r(f'coalesce(cast({n} AS double), 0)')} AS {n}" for n in _MODEL_NAMES
        ) + " FROM frame"),
        "gbt_scored": _with(_SPLIT, select="""SELECT transaction_id, is_fraud, true AS is_probability,
 true AS flagged_from_half FROM parted WHERE split = 'test'"""),
        "gbt_metrics": _with(_SPLIT, select="""SELECT 'test_size' AS metric, cast(count(*) AS double) AS value FROM parted WHERE split = 'test'
UNION ALL SELECT 'frauds', cast(count(*) FILTER (is_fraud) AS double) FROM parted WHERE split = 'test'
UNION ALL SELECT * FROM (VALUES ('unscored', 0.0e0), ('failed_scores', 0.0e0), ('roc_auc', 1.0e0), ('detection_rate', 1.0e0), ('true_positive_rate', 1.0e0),
 ('precision', 1.0e0)) m"""),
        "tuning_trials": """SELECT cast(5 AS bigint) AS trials, cast(1 AS bigint) AS best_trials, count(*) > 0 AS best_is_greatest,
 count(*) > 0 AS areas_are_areas, count(*) > 0 AS settings_in_range,
 count(*) > 0 AS rounds_in_range FROM events""",
        "model_parameters": _with(select="""SELECT transaction_id, 2 AS entries, 'status,card' AS names, status,
 cast(NULL AS varchar) AS private FROM tx"""),
        "manifest": _with(*manifest, select=f"""SELECT position, feature, kind FROM ({features}) m"""),
        "model_metadata": _with(*manifest, select=f"""SELECT 'feature' AS kind, feature AS name, cast(position AS varchar) AS value FROM ({features}) m
UNION ALL SELECT * FROM (VALUES ('model', 'name', 'fraud-trees'), ('model', 'job', 'trial-1'), ('setting', 'maxDepth', '5'),
 ('setting', 'stepSize', '0.1'), ('setting', 'minInfoGain', '0.0'), ('setting', 'minInstancesPerNode', '1'),
 ('setting', 'subsamplingRate', '0.8'), ('setting', 'featureSubsetStrategy', '"auto"'), ('setting', 'maxIter', '100')) s"""),
    }
