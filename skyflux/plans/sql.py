"""DuckDB twins of the bindings, as CTE fragments for the oracle queries."""

PHOT_EV = """phot_ev AS (
  SELECT user_id AS SNID, event_id AS obs_id,
         CAST(40587 AS DOUBLE) + CAST((epoch_us(ts) + 43200) // 86400 AS DOUBLE) / CAST(1000000 AS DOUBLE) AS MJD,
         CASE event_type WHEN 'click' THEN 'g' WHEN 'view' THEN 'r' WHEN 'purchase' THEN 'i'
                         WHEN 'signup' THEN 'z' WHEN 'error' THEN 'Y' END AS BAND,
         value AS FLUXCAL,
         CAST(1 AS DOUBLE) + CAST(json_extract_string(props, '$.k') AS DOUBLE) / CAST(10 AS DOUBLE) AS FLUXCALERR,
         CAST(json_extract_string(props, '$.k') AS INTEGER) * 128 AS PHOTFLAG
  FROM events)"""

TRUTH_EV = """truth_ev AS (
  SELECT c_custkey AS SNID, (c_acctbal + CAST(1000 AS DOUBLE)) / CAST(11000 AS DOUBLE) AS ZCMB, c_nationkey AS GENTYPE
  FROM customer)"""

# detections = PHOTFLAG & 0x1000
ALERTS_EV = """alerts_ev AS (
  SELECT obs_id AS alertId, obs_id AS diaSourceId, SNID AS diaObjectId, MJD AS midPointTai,
         BAND AS filterName, FLUXCAL AS psFlux, FLUXCALERR AS psFluxErr
  FROM phot_ev WHERE (PHOTFLAG & 4096) <> 0)"""

FORCED_EV = """forced_ev AS (
  SELECT obs_id AS diaForcedSourceId, SNID AS diaObjectId, MJD AS midPointTai,
         BAND AS filterName, FLUXCAL AS psFlux, FLUXCALERR AS psFluxErr
  FROM phot_ev)"""

# row layout of the pointer files: file = SNID div 100 + 1, ordered (SNID, MJD, obs_id),
# one gap (separator) after each object
PHOT_RAW = """phot_pos AS (
  SELECT *, printf('%04d', CAST(SNID // 100 + 1 AS BIGINT)) AS file_num,
         row_number() OVER (PARTITION BY SNID // 100 ORDER BY SNID, MJD, obs_id) - 1
           + dense_rank() OVER (PARTITION BY SNID // 100 ORDER BY SNID) - 1 AS row_idx
  FROM phot_ev),
head_ev AS (
  SELECT SNID, file_num, CAST(min(row_idx) + 1 AS INTEGER) AS PTROBS_MIN,
         CAST(max(row_idx) + 1 AS INTEGER) AS PTROBS_MAX
  FROM phot_pos GROUP BY SNID, file_num)"""

MESSAGES_EMB = """emb_raw AS (
  SELECT vec_id, label, list_transform(range(1, 6), lambda i: list_reduce(
           list_transform(range(i, len(embedding) + 1, 5), lambda j: abs(CAST(embedding[j] AS DOUBLE))), lambda a, b: a + b)) AS e
  FROM embeddings),
msg_long AS (
  SELECT vec_id AS messageId, vec_id AS diaSourceId, CAST(vec_id % 3 AS INTEGER) AS classifierId,
         CAST(2222 + label % 5 AS INTEGER) AS trueClassId,
         CAST(2221 + i AS INTEGER) AS classId,
         e[i] / (e[1] + e[2] + e[3] + e[4] + e[5]) AS probability,
         e[i] AS raw_probability
  FROM emb_raw, range(1, 6) r(i))"""

BULK_LI = """bulk_li AS (
  SELECT l_orderkey AS SNID,
         CAST(40587 AS DOUBLE) + CAST((epoch_us(l_shipdate) + 43200) // 86400 AS DOUBLE) / CAST(1000000 AS DOUBLE) AS MJD,
         l_returnflag AS BAND, l_extendedprice AS FLUXCAL, l_quantity AS FLUXCALERR,
         l_linenumber AS PHOTFLAG, l_partkey AS obs_id
  FROM lineitem)"""

SKY_OBJECTS = """sky_objects AS (
  SELECT c_custkey AS objectId,
         ((CAST(c_custkey AS DOUBLE) * CAST(137.50776405 AS DOUBLE)) % CAST(360 AS DOUBLE)) AS ra,
         degrees(asin(CAST(2 AS DOUBLE) * ((CAST(c_custkey AS DOUBLE) * CAST(0.61803398875 AS DOUBLE)) % CAST(1 AS DOUBLE)) - CAST(1 AS DOUBLE))) AS decl
  FROM customer)"""

SKY_SOURCES = """sky_sources AS (
  SELECT s_suppkey AS sourceId,
         ((CAST(s_suppkey AS DOUBLE) * CAST(137.50776405 AS DOUBLE)) % CAST(360 AS DOUBLE)) AS ra,
         degrees(asin(CAST(2 AS DOUBLE) * ((CAST(s_suppkey AS DOUBLE) * CAST(0.61803398875 AS DOUBLE)) % CAST(1 AS DOUBLE)) - CAST(1 AS DOUBLE))) + CAST(0.0002 AS DOUBLE) AS decl
  FROM supplier)"""

TARGETS = """targets AS (SELECT p_partkey AS target_id, CAST(p_size AS DOUBLE) / CAST(1000 AS DOUBLE) AS x FROM part),
candidates AS (SELECT p_partkey AS cand_id, (p_retailprice - CAST(900 AS DOUBLE)) / CAST(4000 AS DOUBLE) AS x FROM part)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
