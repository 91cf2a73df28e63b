"""DuckDB SQL of the registered queries, written independently of the operators."""

from __future__ import annotations

from harvestline.functions.geometry import EARTH_RADIUS_M, REGION_CENTRES


def _r(value: str, scale: int) -> str:
    """Half-up rounding with six guard digits."""
    return f"CAST(round(CAST({value} AS DECIMAL(18,{scale + 6})), {scale}) AS DOUBLE)"


def _composite(day: str) -> str:
    return (
        f"(CAST(date_trunc('year', {day}) AS DATE)"
        f" + CAST(((dayofyear({day}) - 1) // 16) * 16 AS INTEGER))"
    )


def _with(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


def _clean_temp(default: str) -> str:
    return f"CASE WHEN temp_c BETWEEN -40 AND 55 THEN temp_c ELSE {default} END"


CLEAN_PRECIP = "CASE WHEN precip_mm >= 0 THEN precip_mm ELSE 0e0 END"

OBS = """obs AS (
  SELECT CAST(l_suppkey AS INTEGER) AS county_id, CAST(l_shipdate AS DATE) AS date,
         l_quantity * 2 - 45 AS temp_c, round(l_discount * 100 - 2, 2) AS precip_mm
  FROM lineitem)"""

CLEAN = f"""clean AS (
  SELECT county_id, date, {_clean_temp('20e0')} AS temp_c, {CLEAN_PRECIP} AS precip_mm FROM obs)"""

INDICES = f"""indices AS (
  SELECT county_id, CAST({_composite('date')} AS DATE) AS date,
         {_r('avg(temp_c)', 2)} AS avg_temp,
         {_r('sum(precip_mm)', 2)} AS total_precip,
         {_r('sum(CASE WHEN temp_c > 10 THEN temp_c - 10 ELSE 0e0 END)', 2)} AS gdd
  FROM clean GROUP BY 1, 2)"""

SHIFTED = _composite("(CAST(l_shipdate AS DATE) + 200)")
ZONAL = f"""samples AS (
  SELECT CAST(l_suppkey AS INTEGER) AS county_id,
         CAST(CASE WHEN l_linenumber = 7 THEN CAST(l_shipdate AS DATE) ELSE {SHIFTED} END AS DATE)
           AS date,
         l_tax * 10 AS ndvi
  FROM lineitem),
zonal AS (
  SELECT county_id, date, {_r('avg(ndvi)', 4)} AS avg_ndvi FROM samples GROUP BY 1, 2)"""

JOINED = """joined AS (
  SELECT county_id, date, avg_temp, total_precip, gdd, avg_ndvi
  FROM indices JOIN zonal USING (county_id, date))"""

LAGGED = """lagged AS (
  SELECT county_id, date, coalesce(avg_temp, 0) AS avg_temp,
         coalesce(total_precip, 0) AS total_precip, coalesce(gdd, 0) AS gdd,
         coalesce(avg_ndvi, 0) AS avg_ndvi,
         coalesce(lag(avg_ndvi, 1) OVER w, 0) AS ndvi_lag1,
         coalesce(lag(avg_ndvi, 2) OVER w, 0) AS ndvi_lag2,
         coalesce(lag(total_precip, 1) OVER w, 0) AS precip_lag1,
         coalesce(lag(avg_temp, 1) OVER w, 0) AS temp_lag1
  FROM joined WINDOW w AS (PARTITION BY county_id ORDER BY date))"""

ANNUAL = f"""annual AS (
  SELECT county_id, CAST(year(date) AS INTEGER) AS year,
         {_r('avg(avg_ndvi)', 4)} AS mean_ndvi, {_r('max(avg_ndvi)', 4)} AS max_ndvi,
         {_r('sum(total_precip)', 2)} AS annual_precip, {_r('avg(avg_temp)', 2)} AS mean_temp,
         {_r('sum(gdd)', 2)} AS annual_gdd
  FROM lagged GROUP BY 1, 2)"""

YIELDS = """yields AS (
  SELECT CAST(l_suppkey AS INTEGER) AS county_id, l_returnflag AS crop,
         CAST(year(l_shipdate) AS INTEGER) AS year,
         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) // (count(*) * 100) AS DOUBLE)
           / 10000e0 AS yield_mt_ha,
         CAST(sum(l_quantity) AS INTEGER) AS area_ha
  FROM lineitem GROUP BY 1, 2, 3)"""

PREDICTIONS = f"""{YIELDS},
crop_mean AS (SELECT crop, {_r('avg(yield_mt_ha)', 4)} AS predicted_yield FROM yields GROUP BY 1),
predictions AS (
  SELECT county_id, crop, year, yield_mt_ha AS actual_yield, predicted_yield
  FROM yields JOIN crop_mean USING (crop))"""

COUNTIES = """counties AS (
  SELECT CAST(s_suppkey AS INTEGER) AS county_id, s_name AS name, n_name AS country,
         CAST(s_suppkey * 37 % 1440 AS DOUBLE) / 4e0 - 180 AS x0,
         CAST(s_suppkey * 53 % 720 AS DOUBLE) / 4e0 - 90 AS y0,
         CAST(s_suppkey % 4 + 1 AS DOUBLE) / 4e0 AS unit
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""

STREAM_OBS = """stream_obs AS (
  SELECT CAST(user_id AS INTEGER) AS county_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date,
         value AS temp_c, value - 5 AS precip_mm
  FROM events)"""

CLEAN_STREAM = f"""clean_stream AS (
  SELECT county_id, date, {_clean_temp('NULL')} AS temp_c, {CLEAN_PRECIP} AS precip_mm
  FROM stream_obs WHERE county_id IS NOT NULL AND date IS NOT NULL)"""

DAILY = f"""daily AS (
  SELECT county_id, date, {_r('avg(temp_c)', 2)} AS avg_temp,
         {_r('sum(precip_mm)', 2)} AS total_precip, count(*) AS record_count
  FROM clean_stream GROUP BY 1, 2)"""

INVENTORY = """inventory AS (
  SELECT lpad(CAST(c_custkey AS VARCHAR), 6, '0') || '99999' AS station_id,
         'C' || n_regionkey AS ctry,
         CASE WHEN c_custkey % 50 <> 7
              THEN CAST(c_custkey * 7919 % 180001 AS DOUBLE) / 1000e0 - 90 END AS lat,
         CAST(c_custkey * 104729 % 360001 AS DOUBLE) / 1000e0 - 180 AS lon,
         CAST((1940 + c_custkey % 80) * 10000 + 101 + c_custkey % 3 AS INTEGER) AS begin_day,
         CASE WHEN c_custkey % 91 <> 5
              THEN CAST((2000 + c_custkey % 21) * 10000 + 1231 AS INTEGER) END AS end_day
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
active AS (
  SELECT * FROM inventory
  WHERE begin_day <= 19950101
    AND end_day >= least(20011231, (SELECT max(end_day) FROM inventory))
    AND lat IS NOT NULL AND lon IS NOT NULL)"""

CENTRES = """centres AS (
  SELECT CAST(s_suppkey AS INTEGER) AS county_id, 'C' || (s_suppkey % 7) AS country,
         CAST(s_suppkey * 3571 % 180001 AS DOUBLE) / 1000e0 - 90 AS lat,
         CAST(s_suppkey * 91283 % 360001 AS DOUBLE) / 1000e0 - 180 AS lon
  FROM supplier)"""

NEAREST = f"""{INVENTORY}, {CENTRES},
stations AS (
  SELECT station_id, ctry AS country, lat, lon FROM inventory
  WHERE lat IS NOT NULL AND lon IS NOT NULL),
ranked AS (
  SELECT c.county_id, s.station_id,
         (c.lat - s.lat) * (c.lat - s.lat) + (c.lon - s.lon) * (c.lon - s.lon) AS distance,
         row_number() OVER (PARTITION BY c.county_id ORDER BY
           (c.lat - s.lat) * (c.lat - s.lat) + (c.lon - s.lon) * (c.lon - s.lon),
           s.station_id) AS nth
  FROM centres c JOIN stations s
    ON c.country = s.country OR c.country NOT IN (SELECT country FROM stations)),
nearest AS (SELECT county_id, station_id, distance FROM ranked WHERE nth = 1)"""

STATION_OBS = """station_obs AS (
  SELECT o_orderkey, lpad(CAST(o_custkey + 3 AS VARCHAR), 6, '0') || '99999' AS station_id,
         CAST(o_orderdate AS DATE) AS date, o_totalprice / 10000e0 AS temp_c, 0.5e0 AS precip_mm
  FROM orders)"""

STATION_TEXT = """station_text AS (
  SELECT l_orderkey, l_linenumber, l_suppkey, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date,
         CASE WHEN l_quantity IN (49, 50) THEN NULL
              ELSE CAST(CAST(CAST(l_quantity AS INTEGER) * 2 AS VARCHAR) || '.' || l_linenumber
                        AS DOUBLE) END AS fahrenheit,
         CASE CAST(round(l_discount * 100) AS INTEGER)
              WHEN 0 THEN 0e0 WHEN 1 THEN 99.99e0 WHEN 2 THEN 0.1e0 WHEN 3 THEN 90e0
              WHEN 4 THEN 89.99e0 WHEN 5 THEN NULL
              ELSE CAST('0.' || l_linenumber || '5' AS DOUBLE) END AS inches,
         l_extendedprice AS value
  FROM lineitem),
station_metric AS (
  SELECT *, CASE WHEN fahrenheit <= 9000 THEN """ + _r(
    "(fahrenheit - 32e0) * 5 / 9", 2
) + """ END AS temp_c,
         CASE WHEN inches < 90 THEN """ + _r("inches * 25.4e0", 2) + """
              WHEN inches IS NOT NULL THEN 0e0 END AS precip_mm
  FROM station_text)"""

FAO = """fao AS (
  SELECT 'NATION_' || (l_suppkey % 25) AS area,
         upper(split_part(p_name, ' ', 1)[1]) || split_part(p_name, ' ', 1)[2:] || ' '
           || upper(split_part(p_name, ' ', 2)[1]) || split_part(p_name, ' ', 2)[2:] AS item,
         CASE WHEN l_linestatus = 'F' THEN 'Yield' WHEN l_returnflag = 'N' THEN 'Area harvested'
              ELSE 'Stocks' END AS element,
         CAST(year(l_shipdate) AS INTEGER) AS year, l_extendedprice AS value
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def _crop(item: str) -> str:
    return (
        f"CASE WHEN {item} LIKE '%ring%' THEN 'Maize' WHEN {item} LIKE '%red%' THEN 'Wheat'"
        f" WHEN {item} LIKE '%rod%' THEN 'Soybean' END"
    )


FILES = """files AS (
  SELECT o_orderkey, o_custkey % 36 AS h, o_orderkey % 18 AS v, o_orderkey % 4 AS form,
         CAST(o_orderdate AS DATE) AS day
  FROM orders)"""

RASTER = """lines AS (
  SELECT CAST(vec_id // 256 % 2 AS INTEGER) AS tile_h,
         CAST(vec_id % 256 // 64 AS INTEGER) AS tile_v,
         CAST(DATE '2020-01-01' + CAST(vec_id // 512 * 16 AS INTEGER) AS DATE) AS date,
         CAST(vec_id % 64 AS INTEGER) AS pixel_y, embedding
  FROM embeddings),
unpacked AS (
  SELECT tile_h, tile_v, date, pixel_y,
         CAST(unnest(range(len(embedding))) AS INTEGER) AS pixel_x,
         CAST(round(CAST(unnest(embedding) AS DOUBLE) * 10000) AS INTEGER) AS e
  FROM lines),
pixels AS (
  SELECT tile_h, tile_v, date, pixel_y, pixel_x, CASE WHEN e < -2000 THEN -3000 ELSE e END AS raw
  FROM unpacked)"""

ZONES = """zones AS (
  SELECT n_nationkey AS county_id,
         (n_nationkey * 37 % 100) + 0.25e0 AS min_x, (n_nationkey * 53 % 200) + 0.25e0 AS min_y,
         (n_nationkey * 37 % 100) + 5.25e0 + n_nationkey % 40 AS max_x,
         (n_nationkey * 53 % 200) + 5.25e0 + n_nationkey * 3 % 50 AS max_y
  FROM nation)"""

FEATURES = (OBS, CLEAN, INDICES, ZONAL, JOINED, LAGGED)


def _md5_fraction(text: str) -> str:
    return f"CAST(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296e0"


KEY_TEXT = "concat_ws('|', county_id, crop, year)"
AREA_TEXT = "concat_ws('|', 'area', county_id, crop, year)"
YIELD_KEYS_TEXT = "concat_ws('|', county_id, year, crop)"

CENTRE_ROWS = ", ".join(
    f"({i}, '{name}', {lon}e0, {lat}e0)"
    for i, (name, (lon, lat)) in enumerate(REGION_CENTRES.items())
)

PAYLOADS = """forms AS (
  SELECT event_id, event_id % 4 AS form,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
  FROM events)"""

def _number(value: str, trim: bool) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"regexp_replace({text}, '\\.0$', '')" if trim else text


def _outline(point: str, trim: bool) -> str:
    corners = [(0, 0), (2, 0), (2, 1), (1, 1), (1, 2), (0, 2), (0, 0)]
    return " || ', ' || ".join(
        point.format(
            x=_number(f"x0 + unit * {dx}", trim), y=_number(f"y0 + unit * {dy}", trim)
        )
        for dx, dy in corners
    )


MATCH = """targets AS (
  SELECT CAST(s_suppkey AS INTEGER) AS county_id, s_suppkey % 3 AS c,
         CASE s_suppkey % 4 WHEN 0 THEN upper(p_name)
              WHEN 1 THEN substr(split_part(p_name, ' ', 2), 1, 3)
              WHEN 2 THEN split_part(p_name, ' ', 2) || ' zone' ELSE 'qqq' END AS region
  FROM supplier JOIN part ON s_suppkey = p_partkey),
hits AS (
  SELECT county_id, region, p_name, 'C' || c AS country,
         (p_partkey * 7 % (10 + c)) * 1000000 + p_partkey AS p_partkey,
         CASE WHEN p_name = lower(region) THEN 1 WHEN contains(p_name, lower(region)) THEN 2
              ELSE 3 END AS tier
  FROM targets JOIN part ON contains(p_name, split_part(lower(region), ' ', 1))),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY county_id ORDER BY tier, p_partkey) AS nth FROM hits)"""

RUNS = """runs AS (
  SELECT l_linenumber AS line, count(*) AS n, sum(l_quantity) * l_linenumber AS ms
  FROM lineitem GROUP BY 1),
factor AS (
  SELECT round((last.ms / greatest(base.ms, 1)) / (last.n / greatest(base.n, 1)), 3)
           AS scaling_factor
  FROM (SELECT * FROM runs ORDER BY line LIMIT 1) base,
       (SELECT * FROM runs ORDER BY line DESC LIMIT 1) last)"""

SIGNATURE = """printf('%d_%.4f_%d_%.4f', (SELECT count(*) FROM lagged),
        (SELECT coalesce(sum(avg_ndvi), 0) FROM lagged), (SELECT count(*) FROM yields),
        (SELECT coalesce(sum(yield_mt_ha), 0) FROM yields)) AS signature"""

ORACLE: dict[str, str] = {
    "weather_clean_batch": _with(OBS, CLEAN)
    + "SELECT county_id, date, temp_c, precip_mm FROM clean",
    "weather_clean_stream_rules": _with(STREAM_OBS, CLEAN_STREAM)
    + "SELECT county_id, date, temp_c, precip_mm FROM clean_stream",
    "composite_dates": f"""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date,
        CAST({_composite('o_orderdate')} AS DATE) AS composite FROM orders""",
    "weather_indices": _with(OBS, CLEAN, INDICES) + "SELECT * FROM indices",
    "zonal_ndvi": _with(ZONAL) + "SELECT * FROM zonal",
    "feature_join": _with(OBS, CLEAN, INDICES, ZONAL, JOINED) + "SELECT * FROM joined",
    "lag_features": _with(*FEATURES) + "SELECT * FROM lagged",
    "annual_features": _with(*FEATURES, ANNUAL) + "SELECT * FROM annual",
    "training_join": _with(*FEATURES, ANNUAL, YIELDS)
    + "SELECT * FROM annual JOIN yields USING (county_id, year)",
    "county_totals": _with(OBS, CLEAN, INDICES)
    + f"""SELECT county_id, {_r('avg(avg_temp)', 6)} AS avg_temp,
        {_r('sum(total_precip)', 6)} AS total_precip, {_r('sum(gdd)', 6)} AS total_gdd
        FROM indices GROUP BY 1""",
    "county_indices": _with(OBS, CLEAN, INDICES)
    + f"""SELECT county_id, {_r('sum(gdd)', 6)} AS total_gdd, {_r('avg(avg_temp)', 6)} AS avg_temp
        FROM indices GROUP BY 1""",
    "global_mean": _with(OBS, CLEAN, INDICES)
    + f"SELECT {_r('avg(avg_temp)', 6)} AS mean_avg_temp FROM indices",
    "raw_county": _with(OBS)
    + f"""SELECT county_id, {_r('avg(temp_c)', 6)} AS mean_temp_c,
        {_r('sum(precip_mm)', 6)} AS sum_precip_mm FROM obs GROUP BY 1""",
    "daily_summary": _with(STREAM_OBS, CLEAN_STREAM, DAILY) + "SELECT * FROM daily",
    "signature": _with(*FEATURES, YIELDS) + f"SELECT {SIGNATURE}",
    "training_skip": _with(*FEATURES, YIELDS) + f"SELECT {SIGNATURE}, true AS skip",
    "regression_metrics": _with(PREDICTIONS)
    + f"""SELECT count(*) AS n,
        {_r('sqrt(avg((actual_yield - predicted_yield) ** 2))', 6)} AS rmse,
        {_r('1 - sum((actual_yield - predicted_yield) ** 2) / sum((actual_yield - mean) ** 2)', 6)}
          AS r2
        FROM predictions, (SELECT avg(actual_yield) AS mean FROM predictions)""",
    "scaling_factor": _with(RUNS) + "SELECT scaling_factor FROM factor",
    "scaling_report": _with(RUNS)
    + """SELECT line / 7e0 AS fraction, n AS row_count, ms AS latency_ms,
          CAST(NULL AS DOUBLE) AS scaling_factor FROM runs
        UNION ALL SELECT -1e0, 0, 0e0, scaling_factor FROM factor""",
    "format_speedup": """WITH means AS (
        SELECT avg(l_quantity) FILTER (WHERE l_linestatus = 'F') AS orc,
               avg(l_quantity) FILTER (WHERE l_linestatus <> 'F') AS csv FROM lineitem)
        SELECT round(orc, 2) AS orc_latency_ms, round(csv, 2) AS csv_latency_ms,
               round(CASE WHEN orc > 0 THEN csv / orc ELSE 0 END, 2) AS orc_speedup FROM means""",
    "numeric_coercion": """SELECT c_custkey,
        CASE WHEN c_custkey % 4 IN (0, 2) THEN c_acctbal END AS balance,
        CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_custkey AS INTEGER) END AS number FROM customer""",
    "unit_conversions": _with(STATION_TEXT)
    + f"""SELECT l_orderkey, l_linenumber, temp_c, precip_mm,
        {_r('value / 10000e0', 4)} AS yield_t_ha FROM station_metric""",
    "crop_classification": f"SELECT p_partkey, {_crop('p_name')} AS crop FROM part",
    "fao_filter": _with(FAO)
    + """SELECT area AS "Area", item AS "Item", element AS "Element", year AS "Year",
        value AS "Value" FROM fao
        WHERE (area IN ('NATION_3', 'NATION_4') OR contains(area, 'NATION_1'))
          AND regexp_matches(lower(item), 'ring|red|rod') AND year BETWEEN 1996 AND 2000
          AND element IN ('Yield', 'Area harvested')""",
    "national_yields": _with(FAO)
    + f"""SELECT area, item, {_crop('lower(item)')} AS crop, year,
        {_r('value / 10000e0', 4)} AS yield_mt_ha FROM fao
        WHERE element = 'Yield' AND regexp_matches(lower(item), 'ring|red|rod')""",
    "filename_dates": _with(FILES)
    + "SELECT o_orderkey, CASE WHEN form < 3 THEN day END AS date FROM files",
    "tile_affine": _with(FILES)
    + f"""SELECT o_orderkey, CASE WHEN form IN (0, 2) THEN CAST(h AS INTEGER) END AS h,
        CASE WHEN form IN (0, 2) THEN CAST(v AS INTEGER) END AS v,
        CASE WHEN form IN (0, 2)
             THEN {_r('-20015109.354e0 + h * 1111950.5196666666e0', 3)} END AS x_min,
        CASE WHEN form IN (0, 2)
             THEN {_r('10007554.677e0 - v * 1111950.5196666666e0', 3)} END AS y_max,
        {_r('1111950.5196666666e0 / 4800', 3)} AS pixel_size FROM files""",
    "ndvi_scaling": _with(RASTER)
    + """SELECT tile_h, tile_v, date, pixel_y, pixel_x, raw,
        CASE WHEN raw <> -3000 THEN raw / 10000e0 END AS ndvi FROM pixels""",
    "json_payload": _with(PAYLOADS)
    + """SELECT event_id, 0 AS position,
          CASE WHEN form < 2 THEN round(k + 0.5e0, 2) ELSE 20e0 END AS temp_c,
          CASE WHEN form < 2 THEN round(k, 2) WHEN form = 2 THEN 1.25e0 ELSE 0e0 END AS precip_mm
        FROM forms
        UNION ALL
        SELECT event_id, 1, 20e0, 0e0 FROM forms WHERE form = 1""",
    "live_observations": _with(PAYLOADS)
    + """SELECT CAST(user_id AS INTEGER) AS county_id, CAST(ts AS DATE) AS date,
          CASE WHEN form < 2 THEN round(k + 0.5e0, 2) ELSE 20e0 END AS temp_c,
          CASE WHEN form < 2 THEN round(k, 2) WHEN form = 2 THEN 1.25e0 ELSE 0e0 END AS precip_mm
        FROM forms JOIN events USING (event_id)
        UNION ALL
        SELECT -1, CAST(ts AS DATE), 20e0, 0e0 FROM forms JOIN events USING (event_id)
        WHERE form = 1""",
    "station_filter": _with(INVENTORY)
    + """SELECT station_id, ctry AS "CTRY", lat AS "LAT", lon AS "LON", begin_day AS "BEGIN",
        end_day AS "END" FROM active""",
    "top_stations": _with(INVENTORY)
    + """, ranked AS (
        SELECT ctry AS "CTRY", station_id, end_day - begin_day AS duration,
               CAST(row_number() OVER (PARTITION BY ctry
                 ORDER BY end_day - begin_day DESC, station_id) AS INTEGER) AS rank FROM active)
        SELECT * FROM ranked WHERE rank <= 10""",
    "unique_stations": """WITH places AS (
        SELECT 'S' || n_nationkey AS station_id, 'C' || n_regionkey AS country,
               n_nationkey + l_linenumber / 4e0 AS lat, n_nationkey * 2e0 AS lon
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
          JOIN nation ON s_nationkey = n_nationkey)
        SELECT station_id, country, min(lat) AS lat, min(lon) AS lon FROM places GROUP BY 1, 2""",
    "country_lookup": _with(INVENTORY, STATION_OBS)
    + """SELECT o_orderkey, o.station_id, coalesce(i.ctry, '??') AS country,
        CASE o_orderkey % 6 WHEN 0 THEN 'US' WHEN 1 THEN 'IN' WHEN 2 THEN 'BR' WHEN 3 THEN 'CH'
             WHEN 4 THEN 'KE' END AS fips
        FROM station_obs o LEFT JOIN inventory i ON o.station_id = i.station_id""",
    "nearest_station": _with(NEAREST) + "SELECT * FROM nearest",
    "assign_observations": _with(NEAREST, STATION_OBS)
    + """SELECT county_id, date, temp_c, precip_mm
        FROM station_obs JOIN nearest USING (station_id)""",
    "station_files": _with(STATION_TEXT)
    + """SELECT 'S' || lpad(CAST(l_suppkey % 25 AS VARCHAR), 3, '0') AS station_id, date,
        41.5e0 AS lat, -93.5e0 AS lon, temp_c, precip_mm FROM station_metric
        WHERE temp_c IS NOT NULL AND precip_mm IS NOT NULL""",
    "region_match": _with(MATCH)
    + """SELECT county_id, country, region, tier,
        upper(split_part(p_name, ' ', 1)[1]) || split_part(p_name, ' ', 1)[2:] || ' '
          || upper(split_part(p_name, ' ', 2)[1]) || split_part(p_name, ' ', 2)[2:] AS matched,
        p_partkey AS ord
        FROM ordered WHERE nth = 1""",
    "spread_yields": _with(YIELDS, COUNTIES)
    + f""", home AS (
          SELECT 'NATION_' || (county_id % 25) AS country, crop, year,
                 max(yield_mt_ha) AS national FROM yields GROUP BY 1, 2, 3)
        SELECT county_id, crop, year,
               {_r(f'national * (0.85e0 + 0.30e0 * ({_md5_fraction(KEY_TEXT)}))', 4)}
                 AS yield_mt_ha,
               CAST(floor({_md5_fraction(AREA_TEXT)} * 45001) + 5000 AS INTEGER) AS area_ha
        FROM home JOIN counties USING (country)""",
    "geojson_features": _with(COUNTIES)
    + """SELECT county_id,
        '{"type":"Feature","properties":{"county_id":' || county_id || ',"name":"' || name
        || '","country":"' || country
        || '"},"geometry":{"type":"MultiPolygon","coordinates":[[[' || """
    + _outline("'[' || {x} || ',' || {y} || ']'", False).replace("', '", "','")
    + """ || ']]]}}' AS feature FROM counties""",
    "wkt": _with(COUNTIES)
    + "SELECT county_id, 'MULTIPOLYGON (((' || "
    + _outline("{x} || ' ' || {y}", True)
    + " || ')))' AS wkt FROM counties",
    "predictions_named": _with(PREDICTIONS, COUNTIES)
    + """SELECT county_id, crop, year, actual_yield, predicted_yield, name AS county_name, country
        FROM predictions JOIN counties USING (county_id) ORDER BY year, county_id""",
    "regions_list": _with(COUNTIES)
    + "SELECT county_id, name, country FROM counties ORDER BY county_id",
    "polygon_bounds": _with(COUNTIES)
    + """SELECT county_id, x0 AS min_x, y0 AS min_y, x0 + 2 * unit AS max_x,
        y0 + 2 * unit AS max_y FROM counties""",
    "centroids": _with(COUNTIES)
    + f"""SELECT county_id, name, {_r('y0 + unit * 5 / 6', 6)} AS lat,
        {_r('x0 + unit * 5 / 6', 6)} AS lon FROM counties""",
    "sinusoidal": _with(CENTRES)
    + f"""SELECT county_id,
        {_r(f'{EARTH_RADIUS_M}e0 * radians(lon) * cos(radians(lat))', 3)} AS x,
        {_r(f'{EARTH_RADIUS_M}e0 * radians(lat)', 3)} AS y FROM centres""",
    "fallback_polygons": f"""WITH known(i, name, lon, lat) AS (VALUES {CENTRE_ROWS}),
        named AS (
          SELECT CAST(s_suppkey AS INTEGER) AS county_id,
                 CASE WHEN s_suppkey % 10 = 0 THEN s_name ELSE known.name END AS name
          FROM supplier JOIN known ON s_nationkey = i)
        SELECT county_id, name, {_r('coalesce(lon, 0) - 0.5e0', 6)} AS min_x,
               {_r('coalesce(lat, 0) - 0.5e0', 6)} AS min_y,
               {_r('coalesce(lon, 0) + 0.5e0', 6)} AS max_x,
               {_r('coalesce(lat, 0) + 0.5e0', 6)} AS max_y
        FROM named LEFT JOIN known USING (name)""",
    "zonal_stats": _with(RASTER, ZONES)
    + f"""SELECT county_id, tile_h, tile_v, date,
        {_r('CAST(sum(raw) AS DOUBLE) / count(*) / 10000e0', 4)} AS ndvi,
        min(raw) / 10000e0 AS min_ndvi, max(raw) / 10000e0 AS max_ndvi, count(*) AS pixel_count
        FROM pixels JOIN zones
          ON tile_h * 64 + pixel_x + 0.5e0 BETWEEN min_x AND max_x
         AND 256 - (tile_v * 64 + pixel_y + 0.5e0) BETWEEN min_y AND max_y
        WHERE raw <> -3000 GROUP BY 1, 2, 3, 4""",
    "zones_in_tile": _with(RASTER, ZONES)
    + """SELECT county_id, tile_h, tile_v
        FROM (SELECT DISTINCT tile_h, tile_v FROM lines) t JOIN zones
          ON max_x >= tile_h * 64 AND min_x <= tile_h * 64 + 64
         AND min_y <= 256 - tile_v * 64 AND max_y >= 256 - tile_v * 64 - 64""",
    "unseen_inputs": """SELECT o_orderkey, o_custkey FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
    "only_targets": """SELECT event_id, user_id AS key FROM events
        WHERE user_id IN (SELECT s_suppkey FROM supplier)""",
    "union_observations": _with(OBS, STREAM_OBS)
    + """SELECT county_id, CAST(date AS VARCHAR) AS date, temp_c, precip_mm FROM obs
        UNION ALL SELECT county_id, date, temp_c, precip_mm FROM stream_obs""",
    "train_test_split": _with(YIELDS)
    + f"""SELECT county_id, year, crop,
        CASE WHEN {_md5_fraction(YIELD_KEYS_TEXT)} < 0.8e0 THEN 'train' ELSE 'test' END AS part
        FROM yields""",
    "sampled_scaling": f"""WITH drawn AS (
        SELECT l_quantity * 2 - 45 AS temp_c,
               {_md5_fraction("concat_ws('|', 42, l_orderkey, l_linenumber)")} AS draw FROM lineitem)
        SELECT fraction, count(*) AS row_count, {_r('avg(temp_c)', 6)} AS mean_temp_c
        FROM drawn JOIN (SELECT unnest([0.1e0, 0.25e0, 0.5e0, 0.75e0, 1e0]) AS fraction)
          ON draw < fraction
        GROUP BY fraction""",
    "preview": _with(*FEATURES) + "SELECT * FROM lagged ORDER BY county_id, date LIMIT 5",
    "kv_get": _with(OBS, CLEAN, INDICES)
    + """SELECT county_id || '_' || date AS key, * FROM indices
        WHERE county_id || '_' || date = '1_1998-01-01'""",
    "kv_prefix_scan": _with(ZONAL)
    + """SELECT CAST(date AS VARCHAR) AS date, avg_ndvi AS ndvi FROM zonal WHERE county_id = 1
        ORDER BY 1""",
    "weather_series": _with(STREAM_OBS, CLEAN_STREAM, DAILY)
    + """SELECT date, avg_temp, total_precip, record_count FROM daily WHERE county_id = 1
        ORDER BY date""",
    "kv_upsert": """WITH both_sides AS (
        SELECT c_custkey AS key, CAST(0 AS BIGINT) AS epoch, CAST(0 AS BIGINT) AS seq,
               c_acctbal AS value FROM customer
        UNION ALL
        SELECT o_custkey, CAST(CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS BIGINT),
               o_orderkey, o_totalprice FROM orders)
        SELECT key, epoch, seq, value FROM both_sides
        QUALIFY row_number() OVER (PARTITION BY key ORDER BY epoch DESC, seq DESC) = 1""",
    "kv_upsert_buckets": """WITH both_sides AS (
        SELECT c_custkey AS key, CAST(0 AS BIGINT) AS epoch, CAST(0 AS BIGINT) AS seq,
               c_acctbal AS value FROM customer
        UNION ALL
        SELECT o_custkey, CAST(CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS BIGINT),
               o_orderkey, o_totalprice FROM orders)
        SELECT CAST(key AS VARCHAR) AS key, epoch, seq, value FROM both_sides
        QUALIFY row_number() OVER (PARTITION BY key ORDER BY epoch DESC, seq DESC) = 1""",
    "keep_versions": """SELECT user_id || '_' || CAST(ts AS DATE) AS key,
        CAST(hour(ts) AS INTEGER) AS epoch, event_id, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE)
          ORDER BY hour(ts) DESC, event_id DESC) <= 3""",
    "insert_absent": """WITH stored AS (
        SELECT CAST(s_suppkey AS INTEGER) AS county_id, 'A' AS crop, 1998 AS year,
               0e0 AS yield_mt_ha FROM supplier),
        first_rows AS (
        SELECT CAST(l_suppkey AS INTEGER) AS county_id, l_returnflag AS crop,
               CAST(year(l_shipdate) AS INTEGER) AS year, l_extendedprice / 10000e0 AS yield_mt_ha
        FROM lineitem QUALIFY row_number() OVER (
          PARTITION BY l_suppkey, l_returnflag, year(l_shipdate)
          ORDER BY l_orderkey, l_linenumber, l_extendedprice) = 1)
        SELECT * FROM stored UNION ALL
        SELECT * FROM first_rows f WHERE NOT EXISTS (
          SELECT 1 FROM stored s
          WHERE s.county_id = f.county_id AND s.crop = f.crop AND s.year = f.year)""",
    "orc_roundtrip": _with(OBS, CLEAN, INDICES) + "SELECT * FROM indices",
    "csv_roundtrip": _with(OBS)
    + "SELECT county_id, CAST(date AS VARCHAR) AS date, temp_c, precip_mm FROM obs",
    "headerless_csv": _with(YIELDS)
    + "SELECT county_id, crop, year, yield_mt_ha, area_ha FROM yields",
    "ordered_csv": _with(YIELDS) + "SELECT county_id, crop, year, yield_mt_ha, area_ha FROM yields",
    "latin1_csv": _with(FAO)
    + """SELECT 'Côte ' || area AS "Area", item AS "Item", element AS "Element", year AS "Year",
        value AS "Value" FROM fao""",
    "documents_roundtrip": _with(PREDICTIONS) + "SELECT * FROM predictions",
    "small_files": _with(STREAM_OBS) + "SELECT * FROM stream_obs",
    "stream_daily": _with(STREAM_OBS, CLEAN_STREAM, DAILY) + "SELECT * FROM daily",
    "stream_daily_update": _with(STREAM_OBS, CLEAN_STREAM, DAILY) + "SELECT * FROM daily",
    "stream_two_runs": _with(STREAM_OBS, CLEAN_STREAM, DAILY) + "SELECT * FROM daily",
    "stream_spool": _with(STREAM_OBS) + "SELECT * FROM stream_obs",
    "stream_relay": _with(STREAM_OBS, CLEAN_STREAM, DAILY) + "SELECT * FROM daily",
    "ingest_counters": "SELECT 104::BIGINT AS files, count(*) AS records FROM events",
}
