"""The prediction store: projections, predicates, joins, windows, orders and sets."""

from .registry import sql
from .roles import DET, DET_ROWS, IMG, REG, TOTAL

# -- projections and derived columns ------------------------------------------

sql("prj01_typed_manifest_projection", "SELECT event_id AS image_id, try_cast(get_json_object(props, '$.k') AS BIGINT) AS k, try_cast(event_type AS DOUBLE) AS bad_number, coalesce(cast(user_id AS STRING), '') AS creator FROM {events}", "SELECT event_id AS image_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k, try_cast(event_type AS DOUBLE) AS bad_number, coalesce(cast(user_id AS VARCHAR), '') AS creator FROM {events}")
sql("prj02_coerce_to_schema", "SELECT CAST(l_orderkey AS BIGINT) AS image_id, CAST(l_linenumber AS INT) AS det_idx, CAST(NULL AS STRING) AS make, CAST(l_quantity AS BIGINT) AS width FROM {lineitem}", "SELECT CAST(l_orderkey AS BIGINT) AS image_id, CAST(l_linenumber AS INT) AS det_idx, CAST(NULL AS VARCHAR) AS make, CAST(l_quantity AS BIGINT) AS width FROM {lineitem}")
sql("prj03_name_classification", "SELECT page_id, CASE WHEN url LIKE 'https://%' THEN 'secure' WHEN url LIKE 'http://%' THEN 'plain' ELSE 'other' END AS kind, CASE WHEN url LIKE '%.html' THEN 'html' WHEN url LIKE '%/' THEN 'dir' ELSE 'leaf' END AS variant FROM {pages}")
sql("prj04_cell_name_parse", "SELECT c_custkey, nullif(regexp_extract(c_name, '^([A-Za-z]+)#([0-9]+)$', 1), '') AS region, try_cast(nullif(regexp_extract(c_name, '^([A-Za-z]+)#([0-9]+)$', 2), '') AS BIGINT) AS number FROM {customer}")
sql("prj05_parent_by_right_split", "SELECT page_id, nullif(regexp_extract(url, '^(.*)/[^/]+$', 1), '') AS parent FROM {pages}")
sql("prj06_display_name_fallback", "SELECT page_id, coalesce(nullif(regexp_extract(url, '^https?://([^/]+)', 1), ''), 'unknown') AS shown FROM {pages}")
sql("prj07_sanitise_name", "SELECT p_partkey, trim(BOTH '_' FROM regexp_replace(replace(p_name, '&', 'and'), '[^\\\\w.-]', '_')) AS safe FROM {part}", "SELECT p_partkey, trim(regexp_replace(replace(p_name, '&', 'and'), '[^\\w.-]', '_', 'g'), '_') AS safe FROM {part}")
sql("prj09_derived_area", f"WITH {DET_ROWS} SELECT image_id, det_idx, round((qty * 2 - qty) * (qty * 3 - qty), 4) AS area FROM det_rows")
sql("prj10_shorter_side", "SELECT l_orderkey, l_linenumber, least(l_quantity, l_extendedprice) AS shorter FROM {lineitem}")
sql("prj11_absolute_time", "SELECT l_orderkey, l_linenumber, timestampadd(SECOND, l_linenumber, l_shipdate) AS at FROM {lineitem}", "SELECT l_orderkey, l_linenumber, l_shipdate + to_seconds(l_linenumber) AS at FROM {lineitem}")
sql("prj12_attested_three_valued", "SELECT o_orderkey, coalesce(nullif(o_orderpriority, '5-LOW'), 'unattested') AS model, nullif(o_orderstatus, 'P') = 'F' AS attested FROM {orders}")
sql("prj13_presence_flag", "SELECT o_orderkey, l.l_orderkey IS NOT NULL AS has_detections FROM {orders} o LEFT JOIN (SELECT DISTINCT l_orderkey FROM {lineitem}) l ON l.l_orderkey = o.o_orderkey")
sql("prj14_score_band", f"WITH {DET_ROWS} SELECT CAST(least(9, floor((conf + 1e-9) / 0.1)) AS INT) AS band, count(*) AS n FROM det_rows GROUP BY 1")
sql("prj15_confidence_decile", f"WITH {DET_ROWS} SELECT CAST(least(9, floor((conf + 1e-9 - 0.2) / 0.5 * 10)) AS INT) AS decile, count(*) AS n FROM det_rows WHERE conf BETWEEN 0.2 AND 0.7 GROUP BY 1")
sql("prj16_sequence_fallback_key", "SELECT o_orderkey, coalesce(CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE cast(o_custkey AS STRING) END, concat('img:', cast(o_orderkey AS STRING))) AS seq FROM {orders}", "SELECT o_orderkey, coalesce(CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE cast(o_custkey AS VARCHAR) END, concat('img:', cast(o_orderkey AS VARCHAR))) AS seq FROM {orders}")
sql("prj18_box_centre_form", f"WITH {DET_ROWS} SELECT image_id, det_idx, round((qty + qty * 2) / 2 / 200, 9) AS cx, round((qty * 2 - qty) / 200, 9) AS bw FROM det_rows")
sql("prj19_letterbox_inverse", f"WITH {DET_ROWS} SELECT image_id, det_idx, round(greatest(CAST(0 AS DOUBLE), least(CAST(40 AS DOUBLE), (qty - 4) / 1.25)), 9) AS x FROM det_rows")
sql("prj20_power_of_two_reduction", "SELECT p_partkey, CASE WHEN p_size >= 40 THEN 8 WHEN p_size >= 20 THEN 4 WHEN p_size >= 10 THEN 2 ELSE 1 END AS reduce FROM {part}")
sql("prj21_signed_overflow_repair", "SELECT o_orderkey, CAST(CASE WHEN v >= 9223372036854775808 AND v < 18446744073709551616 THEN v - 18446744073709551616 WHEN v >= 0 AND v < 9223372036854775808 THEN v END AS BIGINT) AS fixed FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN CAST(18446744073709551615 AS DECIMAL(38, 0)) - o_orderkey ELSE CAST(o_orderkey AS DECIMAL(38, 0)) END AS v FROM {orders}) t")
sql("prj22_legacy_vocabulary", "SELECT event_id, CASE event_type WHEN 'view' THEN 'seen' ELSE event_type END AS verdict, coalesce(nullif(CASE WHEN user_id % 3 = 0 THEN '' ELSE cast(user_id AS STRING) END, ''), 'admin') AS author FROM {events}", "SELECT event_id, CASE event_type WHEN 'view' THEN 'seen' ELSE event_type END AS verdict, coalesce(nullif(CASE WHEN user_id % 3 = 0 THEN '' ELSE cast(user_id AS VARCHAR) END, ''), 'admin') AS author FROM {events}")
sql("prj23_backend_from_prefix", "SELECT p_partkey, CASE WHEN startswith(p_brand, 'Brand#1') THEN 'one' WHEN startswith(p_brand, 'Brand#2') THEN 'two' ELSE 'rest' END AS backend FROM {part}", "SELECT p_partkey, CASE WHEN starts_with(p_brand, 'Brand#1') THEN 'one' WHEN starts_with(p_brand, 'Brand#2') THEN 'two' ELSE 'rest' END AS backend FROM {part}")
sql("prj24_reply_parse_last_marker", "SELECT conv_id, turn, nullif(coalesce(try_element_at(regexp_extract_all(lower(text), '(the|and)', 1), -1), ''), '') AS answer FROM {conversations}", "SELECT conv_id, turn, regexp_extract_all(lower(text), '(the|and)', 1)[-1] AS answer FROM {conversations}")
sql("prj25_assignment_state", "SELECT event_id, CASE WHEN event_type = 'error' THEN 'cancelled' WHEN value > 50 THEN 'done' WHEN value > 20 THEN 'overdue' ELSE 'open' END AS state FROM {events}")
sql("prj26_region_resolution", "SELECT n_nationkey, coalesce(CASE n_name WHEN 'FRANCE' THEN 'Western Europe' END, CASE WHEN n_regionkey = 3 THEN 'Europe' END, r_name, 'Unassigned') AS resolved FROM {nation} LEFT JOIN {region} ON n_regionkey = r_regionkey")
sql("prj28_run_status_ladder", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'running' WHEN o_totalprice < 1000 THEN 'never_started' WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'early_stopped' WHEN o_orderstatus = 'F' THEN 'completed' ELSE 'interrupted' END AS status FROM {orders}")
sql("prj29_family_label_mapping", "SELECT m.label, count(*) AS n FROM {events} JOIN (SELECT 'click' AS event_type, 'dog' AS label UNION ALL SELECT 'view', 'background') m USING (event_type) GROUP BY m.label")
sql("prj30_bucket_scoring", "WITH s AS (SELECT user_id, event_type, max(value) AS best, avg(value) AS mean, sum(value) AS mass FROM {events} GROUP BY 1, 2) SELECT user_id, max_by(event_type, struct(best, event_type)) AS bucket, round(max(mean), 6) AS top_mean FROM s GROUP BY user_id", "WITH s AS (SELECT user_id, event_type, max(value) AS best, avg(value) AS mean, sum(value) AS mass FROM {events} GROUP BY 1, 2) SELECT user_id, arg_max(event_type, (best, event_type)) AS bucket, round(max(mean), 6) AS top_mean FROM s GROUP BY user_id")

# -- predicates ---------------------------------------------------------------

sql("flt01_membership_filter", "SELECT count(*) AS n FROM {lineitem} SEMI JOIN (SELECT o_orderkey FROM {orders} WHERE o_orderstatus = 'F') w ON l_orderkey = o_orderkey")
sql("flt02_null_aware_cutoff", "SELECT count(*) AS n FROM {orders} WHERE o_orderdate IS NOT NULL AND o_orderdate <= TIMESTAMP_NTZ '1996-01-01 00:00:00'", "SELECT count(*) AS n FROM {orders} WHERE o_orderdate IS NOT NULL AND o_orderdate <= TIMESTAMP '1996-01-01 00:00:00'")
sql("flt03_conf_band_and_size", f"WITH {DET} SELECT image_id, det_idx, conf FROM det WHERE conf BETWEEN 0.25 AND 0.5 AND qty >= 10")
sql("flt04_valid_coordinates", "SELECT count(*) FILTER (WHERE c_acctbal BETWEEN -180 AND 180) AS valid, count(*) FILTER (WHERE NOT c_acctbal BETWEEN -180 AND 180) AS invalid FROM {customer}")
sql("flt05_region_substring", "SELECT n_name, contains(lower(n_name), 'n') AS part, trim(BOTH '_' FROM regexp_replace(replace(n_name, '&', 'and'), '[^\\\\w.-]', '_')) = 'UNITED_STATES' AS same FROM {nation}", "SELECT n_name, contains(lower(n_name), 'n') AS part, n_name = 'UNITED STATES' AS same FROM {nation}")
sql("flt06_prefix_match", "SELECT page_id FROM {pages} WHERE startswith(url, 'https://')", "SELECT page_id FROM {pages} WHERE starts_with(url, 'https://')")
sql("flt07_period_filter_swapped", "SELECT count(*) AS n FROM {orders} WHERE o_orderdate >= least(TIMESTAMP_NTZ '1997-01-01 00:00:00', TIMESTAMP_NTZ '1995-01-01 00:00:00') AND o_orderdate < greatest(TIMESTAMP_NTZ '1997-01-01 00:00:00', TIMESTAMP_NTZ '1995-01-01 00:00:00') + INTERVAL '1' DAY", "SELECT count(*) AS n FROM {orders} WHERE o_orderdate >= least(TIMESTAMP '1997-01-01 00:00:00', TIMESTAMP '1995-01-01 00:00:00') AND o_orderdate < greatest(TIMESTAMP '1997-01-01 00:00:00', TIMESTAMP '1995-01-01 00:00:00') + INTERVAL '1' DAY")
sql("flt08_verdict_views", f"WITH {DET} SELECT CASE WHEN (conf >= 0.5) <> (tax >= 0.04) THEN 'wrong' WHEN tax >= 0.04 THEN 'positive' ELSE 'negative' END AS view, count(*) AS n FROM det WHERE conf IS NOT NULL GROUP BY 1")
sql("flt10_drop_nulls", "SELECT count(*) AS n FROM {documents} WHERE text IS NOT NULL AND lang IS NOT NULL AND source IS NOT NULL")
sql("flt11_area_floor", "SELECT p_brand, p_type, p_size FROM {part} WHERE p_size >= 25")

# -- joins --------------------------------------------------------------------

sql("joi01_inner_multi_key", "SELECT o_orderkey AS image_id, l_linenumber AS det_idx, l_discount AS conf FROM {orders} JOIN {lineitem} ON o_orderkey = l_orderkey AND o_orderstatus = l_linestatus")
sql("joi02_left_images_runs", f"WITH {IMG} SELECT img.image_id, s_name AS run FROM img LEFT JOIN {{supplier}} ON s_suppkey = img.image_id")
sql("joi03_left_four_keys_flag", "SELECT a.l_orderkey, a.l_linenumber, b.l_orderkey IS NOT NULL AS has_image FROM {lineitem} a LEFT JOIN (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM {lineitem} WHERE l_quantity > 25) b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber AND a.l_returnflag = b.l_returnflag AND a.l_linestatus = b.l_linestatus")
sql("joi05_semi_before_aggregate", f"WITH {DET_ROWS}, need AS (SELECT DISTINCT o_orderkey AS image_id FROM {{orders}} WHERE o_totalprice > 200000) SELECT image_id, min(suppkey) AS seq, count(*) AS n FROM det_rows SEMI JOIN need USING (image_id) GROUP BY image_id", f"WITH {DET_ROWS}, need AS (SELECT DISTINCT o_orderkey AS image_id FROM {{orders}} WHERE o_totalprice > 200000) SELECT image_id, min(suppkey) AS seq, count(*) AS n FROM det_rows WHERE image_id IN (SELECT image_id FROM need) GROUP BY image_id")
sql("joi06_in_subquery_counts", "SELECT count(*) AS n, count(DISTINCT l_orderkey) AS ids FROM {lineitem} WHERE l_suppkey IN (SELECT s_suppkey FROM {supplier} WHERE s_acctbal > 0)")
sql("joi07_anti_orphans", "SELECT o_orderkey FROM {orders} ANTI JOIN {lineitem} ON l_orderkey = o_orderkey")
sql("joi08_anti_seen_sequences", "SELECT c_custkey FROM {customer} ANTI JOIN (SELECT o_custkey FROM {orders} WHERE o_orderstatus = 'F') s ON s.o_custkey = c_custkey")
sql("joi09_correlated_not_exists", "SELECT count(*) AS n FROM {lineitem} a WHERE NOT EXISTS (SELECT 1 FROM {lineitem} b WHERE b.l_orderkey = a.l_orderkey AND b.l_linenumber = a.l_linenumber AND b.l_returnflag = 'R' AND b.l_linestatus = a.l_linestatus)")
sql("joi10_not_in_tuple_null_safe", "SELECT count(*) AS n FROM {lineitem} a ANTI JOIN (SELECT DISTINCT l_orderkey, l_linenumber FROM {lineitem} WHERE l_returnflag = 'A') b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber")
sql("joi11_self_join_ordered", f"WITH {DET}, r AS (SELECT DISTINCT image_id, suppkey FROM det) SELECT a.suppkey AS run_a, b.suppkey AS run_b, count(*) AS n FROM r a JOIN r b ON a.image_id = b.image_id AND a.suppkey < b.suppkey GROUP BY 1, 2")
sql("joi12_multi_source_chain", f"WITH {DET}, {IMG}, {REG} SELECT det.image_id, det.det_idx, conf, coalesce(region, 'none') AS region FROM det JOIN img ON img.image_id = det.image_id LEFT JOIN reg ON reg.seq = img.seq WHERE conf >= 0.9")
sql("joi13_key_list_lookup", "SELECT p_partkey, p_name FROM {part} JOIN (SELECT DISTINCT l_partkey FROM {lineitem} WHERE l_quantity >= 50) w ON w.l_partkey = p_partkey")
sql("joi14_condition_in_on", "SELECT o_orderkey, count(l_orderkey) AS positives FROM {orders} LEFT JOIN {lineitem} ON l_orderkey = o_orderkey AND l_discount >= 0.09 GROUP BY o_orderkey")
sql("joi15_set_difference_per_region", f"WITH {IMG}, {REG} SELECT region, count(*) AS missing FROM img JOIN reg USING (seq) ANTI JOIN {{lineitem}} ON l_orderkey = img.image_id GROUP BY region")
sql("joi16_two_way_difference", "WITH a AS (SELECT DISTINCT l_orderkey AS id FROM {lineitem} WHERE l_returnflag = 'A'), b AS (SELECT DISTINCT l_orderkey AS id FROM {lineitem} WHERE l_returnflag = 'R') SELECT count(*) FILTER (WHERE b.id IS NULL) AS orphaned, count(*) FILTER (WHERE a.id IS NULL) AS missing, count(*) FILTER (WHERE a.id = b.id) AS matched FROM a FULL OUTER JOIN b ON a.id = b.id")
sql("joi17_attach_zero_fill", "SELECT n_name, coalesce(c.n, 0) AS customers, coalesce(s.n, 0) AS suppliers FROM {nation} LEFT JOIN (SELECT c_nationkey AS k, count(*) AS n FROM {customer} WHERE c_acctbal > 9000 GROUP BY 1) c ON c.k = n_nationkey LEFT JOIN (SELECT s_nationkey AS k, count(*) AS n FROM {supplier} GROUP BY 1) s ON s.k = n_nationkey")
sql("joi24_hash_bucket_star", "WITH h AS (SELECT doc_id, md5(text) AS h FROM {documents}), m AS (SELECT h, min(doc_id) AS hub, count(*) AS n FROM h GROUP BY h HAVING count(*) > 1) SELECT hub, doc_id FROM h JOIN m USING (h) WHERE doc_id <> hub")
sql("joi25_calibration_join", "SELECT l.quality, count(*) AS n, round(avg(d.n_chars), 4) AS mean_chars FROM {labels} l JOIN {documents} d USING (doc_id) GROUP BY l.quality")
sql("joi26_contamination_guard", "WITH t AS (SELECT p_partkey, explode(regexp_extract_all(p_name, '([a-z]+)', 1)) AS token FROM {part}), train AS (SELECT 'red' AS token UNION ALL SELECT 'blue' UNION ALL SELECT 'part') SELECT count(DISTINCT p_partkey) AS contaminated FROM t SEMI JOIN train ON t.token = train.token", "WITH t AS (SELECT p_partkey, unnest(regexp_extract_all(p_name, '([a-z]+)', 1)) AS token FROM {part}), train AS (SELECT 'red' AS token UNION ALL SELECT 'blue' UNION ALL SELECT 'part') SELECT count(DISTINCT p_partkey) AS contaminated FROM t SEMI JOIN train ON t.token = train.token")
sql("joi27_provenance_resolution", "WITH m AS (SELECT s_nationkey AS run_id, count(*) AS n, min(s_name) AS name FROM {supplier} GROUP BY s_nationkey) SELECT c_custkey, CASE WHEN n IS NULL THEN 'none' WHEN n > 1 THEN 'AMBIGUOUS' WHEN c_acctbal < 0 THEN 'CONFLICT' ELSE 'measured' END AS state, CASE WHEN n = 1 THEN name END AS run FROM {customer} LEFT JOIN m ON run_id = c_nationkey")

# -- windows ------------------------------------------------------------------

sql("win01_twin_collapse_cell_drive", f"WITH {DET_ROWS} SELECT image_id, cell, drive, conf FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY cell, drive, det_idx, {TOTAL}) AS r FROM det_rows) t WHERE r = 1")
sql("win02_twin_collapse_per_box", f"WITH {DET} SELECT image_id, det_idx, drive, cell, conf FROM det")
sql("win03_twin_collapse_other_order", f"WITH {DET_ROWS} SELECT image_id, det_idx, cell, drive FROM (SELECT *, row_number() OVER (PARTITION BY image_id, det_idx ORDER BY cell, drive, {TOTAL}) AS r FROM det_rows) t WHERE r = 1")
sql("win04_one_per_sequence_by_hash", "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY md5(concat(cast(o_orderkey AS STRING), 'salt')), o_orderkey) AS r FROM {orders}) t WHERE r = 1", "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY md5(concat(cast(o_orderkey AS VARCHAR), 'salt')), o_orderkey) AS r FROM {orders}) t WHERE r = 1")
sql("win05_one_per_sequence_by_distance", "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY abs(o_totalprice - 100000), o_orderkey) AS r FROM {orders}) t WHERE r = 1")
sql("win06_rank_in_band_cap", f"WITH {DET} SELECT band, image_id, det_idx FROM (SELECT image_id, det_idx, CAST(least(9, floor((conf + 1e-9) / 0.1)) AS INT) AS band, row_number() OVER (PARTITION BY CAST(least(9, floor((conf + 1e-9) / 0.1)) AS INT) ORDER BY image_id, det_idx) AS r FROM det) t WHERE r <= 5")
sql("win07_interleave_sides", f"WITH {DET}, s AS (SELECT image_id, det_idx, conf >= 0.5 AS side, round(abs(conf - 0.5), 6) AS away FROM det), r AS (SELECT *, row_number() OVER (PARTITION BY side ORDER BY away, image_id, det_idx) AS sn FROM s) SELECT CAST(sn AS BIGINT) AS sn, side, image_id, det_idx FROM r WHERE sn <= 20 ORDER BY sn, away")
sql("win08_keep_last_by_id", f"WITH {DET_ROWS} SELECT image_id, drive, cell FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY shipdate DESC, det_idx DESC, partkey DESC, suppkey DESC, qty DESC, price DESC, tax DESC, conf DESC, drive DESC, cell DESC) AS r FROM det_rows) t WHERE r = 1")
sql("win09_keep_first_composite", f"WITH {DET_ROWS} SELECT image_id, suppkey, det_idx FROM (SELECT *, row_number() OVER (PARTITION BY image_id, suppkey ORDER BY shipdate, det_idx, {TOTAL}) AS r FROM det_rows) t WHERE r = 1")
sql("win10_last_write_wins_retraction", "SELECT user_id, event_type, round(value, 4) AS value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM {events}) t WHERE r = 1 AND event_type <> 'error'")
sql("win11_last_write_after_filter", "SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM {events} WHERE value > 10) t WHERE r = 1")
sql("win12_cap_per_group_seeded", "SELECT l_suppkey, l_orderkey, l_linenumber FROM (SELECT DISTINCT l_suppkey, l_orderkey, l_linenumber, dense_rank() OVER (PARTITION BY l_suppkey ORDER BY md5(concat('7', cast(l_orderkey AS STRING), '_', cast(l_linenumber AS STRING)))) AS r FROM {lineitem}) t WHERE r <= 3", "SELECT l_suppkey, l_orderkey, l_linenumber FROM (SELECT DISTINCT l_suppkey, l_orderkey, l_linenumber, dense_rank() OVER (PARTITION BY l_suppkey ORDER BY md5(concat('7', cast(l_orderkey AS VARCHAR), '_', cast(l_linenumber AS VARCHAR)))) AS r FROM {lineitem}) t WHERE r <= 3")
sql("win13_tiling_gaps_overlaps", "WITH r AS (SELECT conv_id, turn AS lo, turn + 1 AS hi FROM {conversations}), g AS (SELECT conv_id, lo, lag(hi) OVER (PARTITION BY conv_id ORDER BY lo) AS before FROM r) SELECT conv_id, count(*) FILTER (WHERE before < lo) AS gaps, count(*) FILTER (WHERE before > lo) AS overlaps, count(*) FILTER (WHERE before IS NULL AND lo > 0) AS late_start FROM g GROUP BY conv_id")
sql("inv09_parts_tile_range", "SELECT count(*) AS violations FROM (SELECT conv_id FROM {conversations} GROUP BY conv_id HAVING count(*) <> max(turn) + 1 OR min(turn) <> 0) t")
sql("win14_running_best_epoch", "WITH c AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS epoch, value AS fit FROM {events}), b AS (SELECT *, max(fit) OVER (PARTITION BY user_id ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before FROM c) SELECT user_id, CAST(max(epoch) AS BIGINT) AS best_epoch FROM b WHERE best_before IS NULL OR fit > best_before OR best_before = 0 GROUP BY user_id")
sql("win15_peak_ties_earliest", "SELECT user_id, event_id AS peak FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, ts, event_id) AS r FROM {events}) t WHERE r = 1")
sql("win16_trailing_rate", "WITH e AS (SELECT event_id, user_id, (date_diff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)) AS s FROM {events}) SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY s RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) AS in_last_day FROM e", "WITH e AS (SELECT event_id, user_id, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM {events}) SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY s RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) AS in_last_day FROM e")
sql("win17_trailing_boxes_per_image", f"WITH {IMG}, {DET}, n AS (SELECT image_id, count(*) AS n_det FROM det GROUP BY 1) SELECT image_id, round(avg(coalesce(n_det, 0)) OVER (PARTITION BY status ORDER BY image_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW), 6) AS trailing FROM img LEFT JOIN n USING (image_id)")
sql("win18_stall_flag", "WITH e AS (SELECT user_id, event_id, ts, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS was, event_type FROM {events}) SELECT user_id, max(CASE WHEN was IS NULL OR was <> event_type THEN ts END) AS last_move, max(ts) AS last_seen FROM e GROUP BY user_id")
sql("win19_round_robin_interleave", f"WITH {DET_ROWS}, d AS (SELECT drive, image_id, dense_rank() OVER (PARTITION BY drive ORDER BY image_id) - 1 AS i FROM (SELECT DISTINCT drive, image_id FROM det_rows) t) SELECT drive, image_id, CAST(floor(i / 256) AS BIGINT) AS block, CAST(dense_rank() OVER (ORDER BY floor(i / 256), drive) AS BIGINT) AS turn FROM d")
sql("win20_shard_numbers", "WITH n AS (SELECT l_returnflag AS drive, l_linestatus AS cell, count(*) AS n FROM {lineitem} GROUP BY 1, 2) SELECT drive, cell, n, CAST(coalesce(sum(ceil(n / 400.0)) OVER (ORDER BY drive, cell ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first_shard FROM n")
sql("win21_detection_index", f"WITH {DET} SELECT image_id, det_idx, CAST(row_number() OVER (PARTITION BY image_id ORDER BY conf DESC, det_idx) - 1 AS BIGINT) AS idx FROM det")
sql("win22_winner_across_drives", f"WITH {DET_ROWS} SELECT image_id, drive FROM (SELECT image_id, drive, row_number() OVER (PARTITION BY image_id ORDER BY CASE drive WHEN 'N' THEN 0 WHEN 'R' THEN 1 ELSE 2 END) AS r FROM (SELECT DISTINCT image_id, drive FROM det_rows) d) t WHERE r = 1")
sql("win24_seconds_per_epoch", "WITH e AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS epoch, value, lag(value, 10) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM {events}) SELECT user_id, CAST(epoch AS BIGINT) AS epoch, round(CASE WHEN value - before > 0 THEN (value - before) / 10 END, 6) AS pace FROM e")

# -- order, limit, sampling ---------------------------------------------------

sql("srt02_locality_order", f"WITH {DET} SELECT image_id, det_idx, CAST(row_number() OVER (PARTITION BY drive, cell ORDER BY image_id, det_idx) AS BIGINT) AS pos FROM det")
sql("srt05_offset_page_by_row_index", "SELECT row_index, o_orderkey FROM (SELECT CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS row_index, o_orderkey FROM {orders}) t WHERE row_index >= 40 AND row_index < 60")
sql("srt06_clamped_page", "WITH n AS (SELECT count(*) AS n, least(99999, CAST(ceil(count(*) / 25.0) AS BIGINT) - 1) AS last_page FROM {part}), r AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) - 1 AS i FROM {part}) SELECT p_partkey FROM r JOIN n ON floor(i / 25) = last_page")
sql("srt07_systematic_sample", "WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i, count(*) OVER () AS n FROM {orders}) SELECT o_orderkey FROM r WHERE floor(i * 50 / n) <> floor((i - 1) * 50 / n) OR i = 0", "WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i, count(*) OVER () AS n FROM {orders}) SELECT o_orderkey FROM r WHERE floor(i * 50 / n) <> floor((i - 1) * 50 / n) OR i = 0")
sql("srt08_budget_per_file_then_cap", "SELECT l_suppkey, l_orderkey, l_linenumber FROM (SELECT DISTINCT l_suppkey, l_orderkey, l_linenumber, dense_rank() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber) AS r FROM {lineitem}) t WHERE r <= 2 ORDER BY l_suppkey, l_orderkey, l_linenumber LIMIT 30")
sql("srt10_stratified_quota_sheet", f"WITH {DET}, b AS (SELECT image_id, det_idx, CAST(least(9, floor((conf + 1e-9) / 0.1)) AS INT) AS band FROM det), q AS (SELECT band, CASE WHEN band IN (4, 5) THEN 8 ELSE 3 END AS quota FROM b GROUP BY band), r AS (SELECT b.*, row_number() OVER (PARTITION BY band ORDER BY image_id, det_idx) AS r FROM b) SELECT r.band, image_id, det_idx FROM r JOIN q ON q.band = r.band WHERE r <= quota")
sql("srt11_seeded_shuffle_prefix", "SELECT doc_id FROM {documents} ORDER BY md5(concat('42', cast(doc_id AS STRING))) LIMIT 50", "SELECT doc_id FROM {documents} ORDER BY md5(concat('42', cast(doc_id AS VARCHAR))) LIMIT 50")
sql("srt12_group_split_to_fraction", "WITH g AS (SELECT o_custkey, count(*) AS n FROM {orders} GROUP BY 1), c AS (SELECT o_custkey, n, sum(n) OVER (ORDER BY md5(cast(o_custkey AS STRING)), o_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before, sum(n) OVER () AS total FROM g) SELECT o_custkey, CASE WHEN coalesce(before, 0) < 0.2 * total THEN 'val' ELSE 'train' END AS split FROM c", "WITH g AS (SELECT o_custkey, count(*) AS n FROM {orders} GROUP BY 1), c AS (SELECT o_custkey, n, sum(n) OVER (ORDER BY md5(cast(o_custkey AS VARCHAR)), o_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before, sum(n) OVER () AS total FROM g) SELECT o_custkey, CASE WHEN coalesce(before, 0) < 0.2 * total THEN 'val' ELSE 'train' END AS split FROM c")
sql("srt13_group_reservation", "WITH g AS (SELECT o_custkey, count(*) AS n FROM {orders} GROUP BY 1), c AS (SELECT o_custkey, n, coalesce(sum(n) OVER (ORDER BY n DESC, o_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM g) SELECT o_custkey, n FROM c WHERE before < 100")
sql("srt14_newest_first_limit", "SELECT event_id, ts FROM {events} ORDER BY ts DESC, event_id DESC LIMIT 25")
sql("srt15_errors_invented_first", f"WITH {DET} SELECT image_id, det_idx, CASE WHEN conf >= 0.8 AND tax < 0.02 THEN 'invented' ELSE 'missed' END AS error, conf FROM det WHERE (conf >= 0.8 AND tax < 0.02) OR (conf < 0.2 AND tax > 0.06) ORDER BY CASE WHEN conf >= 0.8 THEN 0 ELSE 1 END, conf DESC, image_id")

# -- sets ---------------------------------------------------------------------

sql("set01_union_distinct_ids", "SELECT l_orderkey AS id FROM {lineitem} WHERE l_returnflag = 'A' UNION SELECT o_orderkey FROM {orders} WHERE o_orderstatus = 'P'")
sql("set02_concat_relaxed", "SELECT c_custkey AS id, c_name AS name, CAST(NULL AS DOUBLE) AS price FROM {customer} UNION ALL SELECT p_partkey, p_name, p_retailprice FROM {part}")
sql("set03_concat_branches", "SELECT count(*) AS n FROM (SELECT o_orderkey FROM {orders} WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey FROM {orders} WHERE o_orderstatus <> 'F') t")
sql("set04_difference", "SELECT o_orderkey AS id FROM {orders} EXCEPT SELECT l_orderkey FROM {lineitem}")
sql("set05_intersection", "SELECT c_nationkey AS k FROM {customer} INTERSECT SELECT s_nationkey FROM {supplier}")
sql("set06_containment", "SELECT NOT EXISTS (SELECT 1 FROM {lineitem} ANTI JOIN {orders} ON o_orderkey = l_orderkey) AS contained")
sql("set07_union_larger_wins", "SELECT k, name, origin FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY size DESC, origin) AS r FROM (SELECT c_nationkey AS k, c_name AS name, c_acctbal AS size, 'c' AS origin FROM {customer} UNION ALL SELECT s_nationkey, s_name, s_acctbal, 's' FROM {supplier}) u) t WHERE r = 1")
sql("set08_straddle_check", "WITH s AS (SELECT o_custkey AS g, CASE WHEN substr(md5(cast(o_custkey AS STRING)), 1, 1) < '4' THEN 'val' ELSE 'train' END AS split FROM {orders}) SELECT count(*) AS violations FROM (SELECT g FROM s WHERE split = 'train' INTERSECT SELECT g FROM s WHERE split = 'val') t", "WITH s AS (SELECT o_custkey AS g, CASE WHEN substr(md5(cast(o_custkey AS VARCHAR)), 1, 1) < '4' THEN 'val' ELSE 'train' END AS split FROM {orders}) SELECT count(*) AS violations FROM (SELECT g FROM s WHERE split = 'train' INTERSECT SELECT g FROM s WHERE split = 'val') t")
sql("inv14_no_group_straddles", "SELECT count(*) AS violations FROM (SELECT o_custkey FROM (SELECT o_custkey, CASE WHEN o_custkey % 5 = 0 THEN 'val' ELSE 'train' END AS split FROM {orders}) s GROUP BY o_custkey HAVING count(DISTINCT split) > 1) t")
sql("set09_exclusion_sources", "WITH a AS (SELECT DISTINCT l_orderkey AS id FROM {lineitem} WHERE l_returnflag = 'A'), b AS (SELECT DISTINCT l_orderkey AS id FROM {lineitem} WHERE l_returnflag = 'R') SELECT (SELECT count(*) FROM a) + (SELECT count(*) FROM b) AS summed, (SELECT count(*) FROM (SELECT id FROM a UNION SELECT id FROM b) u) AS distinct_ids")

sql("prj08_hive_path_parse", "SELECT page_id, nullif(regexp_extract(url, '^([a-z]+)://', 1), '') AS scheme, nullif(regexp_extract(url, '^[a-z]+://([^/]+)', 1), '') AS host, nullif(regexp_extract(url, '^[a-z]+://[^/]+/([^/?#]+)', 1), '') AS head FROM {pages}")
sql("flt09_bbox_overlap_closed", "SELECT s_suppkey FROM {supplier} WHERE s_acctbal <= 5000 AND s_acctbal + 500 >= 4000 AND s_nationkey <= 20 AND s_nationkey + 2 >= 5")
sql("src03_single_row_by_position", "SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_index FROM {orders}) t WHERE row_index = 17")
sql("src04_scan_with_pruning", "SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM {lineitem} WHERE l_shipdate >= TIMESTAMP_NTZ '1995-01-01 00:00:00' AND l_quantity < 24 GROUP BY l_returnflag", "SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM {lineitem} WHERE l_shipdate >= TIMESTAMP '1995-01-01 00:00:00' AND l_quantity < 24 GROUP BY l_returnflag")
sql("src14_id_by_pattern", "SELECT event_id, nullif(regexp_extract(props, '\"k\"\\s*:\\s*([0-9]+)', 1), '') AS k FROM {events}".replace("\\s*", "[ ]*"))
sql("src17_line_set", "SELECT DISTINCT trim(text) AS line FROM {benchmark} WHERE NOT trim(text) LIKE '#%' AND trim(text) <> ''")
sql("srt03_sort_inside_part", "SELECT l_suppkey, l_orderkey, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice) AS BIGINT) AS pos FROM {lineitem}")
sql("srt09_stratified_by_decile", f"WITH {DET}, c AS (SELECT image_id, det_idx, cell, conf, CAST(least(9, floor((conf + 1e-9) * 10)) AS INT) AS decile FROM det), one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY md5(concat(cast(image_id AS STRING), ':', cast(det_idx AS STRING)))) AS ri FROM c) t WHERE ri = 1), capped AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY decile, cell ORDER BY image_id) AS rc FROM one) t WHERE rc <= 6) SELECT decile, cell, image_id FROM (SELECT *, row_number() OVER (PARTITION BY decile ORDER BY rc, cell) AS rd FROM capped) t WHERE rd <= 10", f"WITH {DET}, c AS (SELECT image_id, det_idx, cell, conf, CAST(least(9, floor((conf + 1e-9) * 10)) AS INT) AS decile FROM det), one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY md5(concat(cast(image_id AS VARCHAR), ':', cast(det_idx AS VARCHAR)))) AS ri FROM c) t WHERE ri = 1), capped AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY decile, cell ORDER BY image_id) AS rc FROM one) t WHERE rc <= 6) SELECT decile, cell, image_id FROM (SELECT *, row_number() OVER (PARTITION BY decile ORDER BY rc, cell) AS rd FROM capped) t WHERE rd <= 10")
sql("joi21_intersecting_distinct_list", "WITH a AS (SELECT s_nationkey AS k, s_acctbal AS lo, s_acctbal + 200 AS hi FROM {supplier}), r AS (SELECT r_regionkey, r_name, r_regionkey * 2000 AS lo, r_regionkey * 2000 + 900 AS hi FROM {region}) SELECT DISTINCT r_name, k FROM a JOIN r ON a.lo <= r.hi AND a.hi >= r.lo")
sql("pip21_reserve_whole_groups", "WITH g AS (SELECT o_custkey AS grp, count(*) AS ids FROM {orders} GROUP BY 1), c AS (SELECT grp, ids, coalesce(sum(ids) OVER (ORDER BY md5(concat('reserve', cast(grp AS STRING))), grp ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM g) SELECT grp, ids FROM c WHERE before < 60", "WITH g AS (SELECT o_custkey AS grp, count(*) AS ids FROM {orders} GROUP BY 1), c AS (SELECT grp, ids, coalesce(sum(ids) OVER (ORDER BY md5(concat('reserve', cast(grp AS VARCHAR))), grp ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM g) SELECT grp, ids FROM c WHERE before < 60")
