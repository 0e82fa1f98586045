"""Views over the given tables, as texts that both engines run.

The given tables hold no nulls and no faults, so faults are planted into some values here. No row
is left out.
"""

from __future__ import annotations

# A table with faults for quality checks.
CUSTOMER_DQ = """
select concat('C', c_custkey) as customer_id,
 case when c_custkey % 10 = 0 then null when c_custkey % 7 = 0 then 'Same Name'
      when c_custkey % 11 = 0 then concat('user', c_custkey, '@example.com') else c_name end as customer_name,
 c_mktsegment as segment,
 case when c_custkey % 13 = 0 then null else cast(18 + c_custkey % 60 as int) end as age,
 n_name as country, concat('City', c_nationkey) as city, substr(n_name, 1, 2) as state,
 cast(10000 + c_custkey % 500 as bigint) as postal_code, r_name as region,
 case when c_custkey % 17 = 0 then '2024-13-45'
      else concat('2024-01-', right(concat('0', 1 + c_custkey % 28), 2), ' 08:00:00') end as timestamp,
 cast('2024-02-01 00:00:00' as timestamp) as insertion_timestamp
from {customer} join {nation} on c_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey
"""

# A table with a sensitive column. The digits are invented.
COMPLEX_TYPES = """
select o_orderkey as row_id,
 case when o_orderkey % 5 = 0 then null else cast(o_orderkey % 1000 as int) end as int,
 case when o_orderkey % 9 = 0 then null
      else right(concat('5100000000000000', o_orderkey), 16) end as masterCard
from {orders}
"""

# Task runs: the input of audit records.
TASK_RUNS = """
select event_id as run_id, concat('asset_', user_id % 20) as asset_id, 'lake_landing' as dag_id,
 concat('src_', user_id % 20) as source_name,
 case event_type when 'purchase' then 'success' when 'click' then 'success'
      when 'error' then 'failed' when 'view' then 'running' else null end as state,
 date_trunc('hour', ts) as execution_date, ts as start_date,
 case when event_type in ('purchase','click','error') then ts + interval '90' second else null end as end_date,
 cast(1 + event_id % 3 as int) as try_number,
 case event_type when 'error' then null else concat('job_', event_id) end as job_id,
 case when event_id % 2 = 0 then 'Dataproc' when event_id % 3 = 0 then 'dataflow' else 'manual' end as job_type,
 concat('Grp', user_id % 3) as group_name, concat('host', user_id % 4) as host,
 concat('db', user_id % 5) as database, concat('table', user_id % 6) as table_name,
 concat('zone/out', user_id % 20) as destination, 'sftp_to_gcs' as task_type, 'Task_' as task_name,
 event_id * 10 as source_count, event_id * 10 - event_id % 2 as destination_count,
 'proj' as project, concat('zone/in', user_id % 20) as source, 'files' as source_type,
 'reports/profile' as profiling_path, 'reports/checks' as expectations_path
from {events}
"""
RUN_TIME = "2024-06-01 12:00:00.250000"
