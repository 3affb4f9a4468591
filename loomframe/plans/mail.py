"""E-mail queries on the derived message headers."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomframe.operators import mail as m
from loomframe.operators import relational as rel
from loomframe.plans.registry import Registry, rounded
from loomframe.plans.views import messages, with_views

plan = Registry()
BASE = with_views("messages")
SUBJECT, ADDRESS = "Topic 5-LOW", "u7@corp.com"
PLAIN_DATE = "strptime(substr(date, 6, 26), '%d %b %Y %H:%M:%S %z')"


@plan.add(f"{BASE} SELECT * FROM messages WHERE bcc IS NOT NULL AND bcc <> ''")
def has_field(spark, sf_dir):
    return rel.has_field(messages(spark, sf_dir), "bcc")


@plan.add(f"""{BASE} SELECT id, subject, CAST(epoch({PLAIN_DATE}) AS BIGINT) AS sent FROM messages
WHERE regexp_matches(subject, '^((?i:re|fwd|fw): )+Topic 5-LOW$')""")
def emails_in_thread(spark, sf_dir):
    found = m.emails_in_thread(messages(spark, sf_dir), SUBJECT)
    return found.select("id", "subject", F.unix_timestamp("sent").alias("sent"))


@plan.add(f"{BASE} SELECT id, CAST(epoch({PLAIN_DATE}) AS BIGINT) AS sent FROM messages")
def mail_date(spark, sf_dir):
    return messages(spark, sf_dir).select(
        "id", F.unix_timestamp(m.mail_date(F.col("date"))).alias("sent"))


@plan.add(f"{BASE} SELECT id, date LIKE 'S%' AS weekend FROM messages")
def is_weekend(spark, sf_dir):
    return messages(spark, sf_dir).select("id", m.is_weekend(F.col("date")).alias("weekend"))


@plan.add(f"{BASE} SELECT round(avg(CASE WHEN date LIKE 'S%' THEN 1.0::DOUBLE ELSE 0 END), 9) "
          "AS share FROM messages")
def weekend_share(spark, sf_dir):
    return rounded(m.weekend_share(messages(spark, sf_dir)))


ENTRIES = """SELECT DISTINCT name FROM (
  SELECT unnest(string_split(split_part(entry, ' <', 1), ''', ')) AS name FROM (
    SELECT unnest(string_split(bcc, '>, ')) AS entry FROM messages
    WHERE bcc IS NOT NULL AND bcc <> ''))"""


@plan.add(f"{BASE} {ENTRIES}")
def split_bcc(spark, sf_dir):
    return m.split_bcc(messages(spark, sf_dir))


# One row per character read: the item so far and what it looks like.
@plan.add(BASE.replace("WITH", "WITH RECURSIVE", 1) + f""", entries AS ({ENTRIES}),
walk AS (
  SELECT name || ',' AS t, 0 AS i, '' AS item, false AS mail, false AS half,
    CAST(NULL AS VARCHAR) AS got FROM entries
  UNION ALL
  SELECT t, i + 1, CASE WHEN skip OR ends THEN '' ELSE item || c END,
    (mail OR c = '@') AND NOT ends,
    CASE WHEN NOT skip AND NOT mail AND c = ',' THEN NOT half ELSE half END,
    CASE WHEN ends THEN item END
  FROM (SELECT *, NOT skip AND ((mail AND c IN (',', '''')) OR (NOT mail AND c = ',' AND half))
          AS ends
        FROM (SELECT *, item = '' AND c IN ('''', ' ', ',') AS skip
              FROM (SELECT *, substr(t, i + 1, 1) AS c FROM walk WHERE i < length(t)))))
SELECT DISTINCT name FROM (SELECT got AS name FROM walk
  UNION SELECT substr(item, 1, length(item) - 1) FROM walk WHERE i = length(t))
WHERE name <> ''""")
def clean_names(spark, sf_dir):
    return m.clean_names(m.split_bcc(messages(spark, sf_dir)), "name")


TRAFFIC = f"""{BASE}, mine AS (
  SELECT id, sender, coalesce(sender = '{ADDRESS}', false) AS outgoing,
    CASE WHEN coalesce(sender = '{ADDRESS}', false)
         THEN rcpt || coalesce(', ' || cc, '') ELSE '{ADDRESS}' END AS r
  FROM messages WHERE sender = '{ADDRESS}' OR contains(rcpt, '{ADDRESS}')
    OR contains(cc, '{ADDRESS}')),
lines AS (SELECT id, sender, outgoing,
  unnest(string_split(r, ', ' || chr(13) || chr(10) || chr(9))) AS r FROM mine),
each AS (SELECT DISTINCT * FROM (SELECT id, sender, outgoing, unnest(string_split(r, ', ')) AS r
  FROM lines))
SELECT CASE WHEN outgoing THEN r ELSE sender END AS contact,
  count_if(NOT outgoing)::BIGINT AS "from", count_if(outgoing)::BIGINT AS "to", count(*) AS total
FROM each GROUP BY 1"""


@plan.add(TRAFFIC)
def contact_traffic(spark, sf_dir):
    return m.contact_traffic(messages(spark, sf_dir), ADDRESS)


@plan.add(TRAFFIC + " ORDER BY total DESC, contact LIMIT 10")
def contact_traffic_top(spark, sf_dir):
    return m.contact_traffic(messages(spark, sf_dir), ADDRESS, 10)
