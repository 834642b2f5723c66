"""DuckDB SQL with the expected result of each query.

``m`` holds one row per message.  Phones and errors come from the arithmetic that built
the messages, never from reading their bytes."""

MESSAGES = """
with a as (
  select event_id, event_type, user_id, event_id % 10 as k,
         (event_id // 10) % 10 as s, (event_id // 100) % 10 as t
  from events),
b as (
  select *, case k
      when 2 then concat('+380', lpad(cast(user_id as varchar), 9, '0'))
      when 3 then concat('8', lpad(cast(user_id as varchar), 10, '0'))
      when 4 then ''
      when 5 then null
      when 6 then concat('+7', lpad(cast(user_id as varchar), 9, '0'))
      when 7 then concat('x+7', lpad(cast(user_id as varchar), 10, '0'))
      when 8 then concat('+7', lpad(cast(user_id as varchar), 10, '0'), ' ')
      else concat('+7', lpad(cast(user_id as varchar), 10, '0')) end as p0
  from a),
c as (
  select *, case when s = 3 then coalesce(p0, '') else p0 end as p from b),
d as (
  select *,
    unhex(lpad(to_hex(2 * length(event_type)), 2, '0')) || encode(event_type) as av_type,
    unhex(lpad(to_hex(2 * length(coalesce(p, ''))), 2, '0')) || encode(coalesce(p, '')) as av_phone
  from c),
e as (
  select *,
    case when p is null then av_type || unhex('00')
         else av_type || unhex('02') || av_phone end as body7,
    av_phone || av_type as body8
  from d),
f as (
  select *,
    case when s in (6, 7) then 'empty_value'
         when s = 8 then 'bad_wire_header'
         when s = 9 then 'unknown_schema'
         when s = 4 and t = 9 then 'decode_failed' end as error,
    case when s in (0, 1, 2, 4) then 7 when s = 3 then 8 when s = 9 then 4294967294
         end as schema_id,
    case when s = 4 and t = 9 then unhex('10') || encode('abc')
         when s = 3 then body8
         when s in (6, 7, 8) then null
         else body7 end as payload
  from e),
g as (
  select *,
    case when schema_id is not null
           then unhex('00' || lpad(to_hex(schema_id), 8, '0')) || payload
         when s = 6 then null
         when s = 7 then unhex('')
         when s = 8 then unhex('0000')
         else payload end as value
  from f),
m as (
  select event_id, event_type, user_id, k, s, t, p, schema_id, payload, error,
    hex(encode(cast(user_id as varchar))) as key_hex, hex(value) as value_hex,
    coalesce(octet_length(value), 0) as value_size,
    case when event_id % 2 = 0 then 'raw-a' else 'raw-b' end as source_topic,
    case when error is null then p end as phone
  from g)
"""


def bucket(text, *, start="^", rest="'rest'"):
    """Bucket of a text under the usual rules; ``start`` is what stands before each."""
    return (
        f"case when regexp_matches({text}, '{start}\\+7[0-9]{{10}}$') then 'ru' "
        f"when regexp_matches({text}, '{start}\\+380[0-9]{{9}}$') then 'ua' else {rest} end"
    )


TEXT = "coalesce(phone, '')"
BUCKET = f"case when error is null then {bucket(TEXT)} end"
TOPIC = f"case when error is null then 'route_' || {bucket(TEXT)} else 'errors' end"

# Reading every body with schema 7 under the lenient policy, whatever id it names.
ALL_AS_7_ERROR = (
    "case when s in (6, 7) then 'empty_value' when s = 3 or (s = 4 and t = 9) then 'decode_failed' end"
)
ALL_AS_7_PHONE = "case when s in (0, 1, 2, 4, 5, 9) and not (s = 4 and t = 9) then p end"

# The same with schema 8: the first text of a body is taken for the phone.
ALL_AS_8_ERROR = (
    "case when s in (6, 7) then 'empty_value' when s = 4 and t = 9 then 'decode_failed' end"
)
ALL_AS_8_PHONE = (
    "case when s in (6, 7) or (s = 4 and t = 9) then null "
    "when s = 3 then p when s = 8 then '' else event_type end"
)

STRICT_ERROR_WITH_7 = (
    "case when s in (6, 7) then 'empty_value' when s = 8 then 'bad_wire_header' "
    "when s = 3 or (s = 4 and t = 9) then 'decode_failed' end"
)

MESSAGE_TEXT = (
    "case when s = 6 then 'Empty value' when s = 7 then 'Empty payload' "
    "when s = 8 then 'Bad wire header (no schema id)' else error end"
)
READER_TEXT = (
    "case when error in ('empty_value', 'bad_wire_header') then 'wire_error: ' || error "
    "when error = 'decode_failed' then 'from_avro_failed' else error end"
)

BRANCH = (
    "event_id, key_hex, value_hex, "
    "case when error is null then 'trace' else 'error' end as header_key, "
    "case when error is null then cast(event_id as varchar) else error end as header_value, "
    f"{TOPIC} as topic"
)

MESSAGE_SIZE = (
    "128 + 16 + 5 + value_size + length(key_hex) // 2 "
    "+ length(case when error is null then cast(event_id as varchar) else error end)"
)


def of_messages(columns, where="true"):
    return f"{MESSAGES} select {columns} from m where {where}"


def buckets(expression):
    return of_messages(f"event_id, case when error is null then {expression} end as bucket")


def with_schema(source, phone, error):
    return f"select '{source}' as source, event_id, {phone} as phone, {error} as error from m"


SWAPPED = f"case {bucket(TEXT)} when 'ru' then 'ua' when 'ua' then 'ru' else 'rest' end"
MANY = (
    "case when regexp_matches(coalesce(phone, ''), '^\\+7[0-9]{10}$') "
    "then 'ru' || right(phone, 2) "
    "when regexp_matches(coalesce(phone, ''), '^\\+380[0-9]{9}$') "
    "then 'ua' || right(phone, 2) else 'rest' end"
)
THOUSAND = (
    "case when regexp_matches(coalesce(phone, ''), '^\\+7[0-9]{10}$') "
    "then 'ru' || if(right(phone, 3) < '500', right(phone, 3), '') "
    "when regexp_matches(coalesce(phone, ''), '^\\+380[0-9]{9}$') "
    "then 'ua' || if(right(phone, 3) < '500', right(phone, 3), '') else 'rest' end"
)

ORACLE = {
    "q_wire_split": of_messages(
        "event_id, schema_id, hex(payload) as payload_hex, "
        "case when s in (6, 7) then 'empty_value' when s = 8 then 'bad_wire_header' end as wire_error"
    ),
    "q_wire_split_lenient": of_messages(
        "event_id, schema_id, case when s = 8 then '0000' else hex(payload) end as payload_hex, "
        "case when s in (6, 7) then 'empty_value' end as wire_error"
    ),
    "q_schema_latest": """
        select event_type || '-value' as subject, max(event_id) as version,
               max(event_id) + 1000 as schema_id,
               '{"type":"record","name":"E","fields":[{"name":"f'
                 || cast(arg_max(user_id, event_id) as varchar)
                 || '","type":"long"}]}' as schema_json
        from events group by event_type""",
    "q_schema_attach": of_messages(
        "event_id, schema_id, case when schema_id is not null then schema_id in (7, 8) end as known"
    ),
    "q_schema_file": MESSAGES + with_schema("file", ALL_AS_7_PHONE, ALL_AS_7_ERROR),
    "q_schema_precedence": MESSAGES
    + with_schema("inline", ALL_AS_8_PHONE, ALL_AS_8_ERROR)
    + " union all "
    + with_schema("file", ALL_AS_7_PHONE, ALL_AS_7_ERROR)
    + " union all "
    + with_schema("registry", ALL_AS_8_PHONE, ALL_AS_8_ERROR),
    "q_decode_phone": of_messages("event_id, phone, error as decode_error"),
    "q_decode_default": of_messages("event_id, phone, error"),
    "q_no_default_schema": of_messages(
        "event_id, case when s <> 5 then phone end as phone, "
        "case when s = 5 then 'no_default_schema' else error end as error"
    ),
    "q_decode_single_schema": of_messages(
        f"event_id, {ALL_AS_7_PHONE} as phone, {STRICT_ERROR_WITH_7} as decode_error"
    ),
    "q_decode_full": of_messages(
        "event_id, case when error is null then event_type end as event_type, phone"
    ),
    "q_decode_nested": of_messages("event_id, phone"),
    "q_decode_missing_field": buckets("'rest'"),
    "q_decode_types": """
        select event_id, cast(user_id as int) as user, event_id % 2 = 1 as flag,
               case when event_id % 2 = 1 then 1.5::double else -2.5::double end as ratio,
               cast(round(value * 100) as bigint) as amount_cents,
               epoch_us(ts) as ts_micros,
               cast(epoch_us(ts) // 86400000000 as int) as day_number,
               case event_id % 3 when 0 then '' when 1 then event_type
                    else event_type || ',' || event_type end as tags,
               user_id + event_id % 10 as numbers_sum, 2 as attrs_size,
               event_id % 10 as attr_k,
               case when event_id % 10 <> 0 then event_type end as inner_name,
               case event_id % 3 when 0 then 'red' when 1 then 'green' else 'blue' end as colour,
               'ABCD' as mark_hex, hex(encode(event_type)) as blob_hex,
               case when event_id % 10 = 1 then null when event_id % 2 = 0 then event_type
                    else 'true' end as either_text,
               case when event_id % 2 = 0 then event_type end as either_string,
               case when event_id % 2 = 1 and event_id % 10 <> 1 then true end as either_boolean,
               cast(null as varchar) as decode_error
        from events""",
    "q_decode_large_registry": """
        select event_id, user_id + 1000 as schema_id,
               case when user_id % 2 = 0 then cast(user_id as varchar) else 'true' end as phone,
               cast(null as varchar) as decode_error
        from events""",
    "q_route_first": buckets(bucket(TEXT)),
    "q_route_last": buckets("'rest'"),
    "q_route_search": buckets(bucket(TEXT, start="")),
    "q_route_anchored": buckets(bucket(TEXT, start="\\A")),
    "q_route_null": buckets("case when coalesce(phone, '') = '' then 'blank' else 'rest' end"),
    "q_route_null_default": buckets("case when phone = '' then 'blank' else 'rest' end"),
    "q_route_many_rules": buckets(MANY),
    "q_route_1000_rules": buckets(THOUSAND),
    "q_no_route": of_messages(
        "event_id, case when error is not null then error "
        f"when {bucket(TEXT, rest='null')} is null then 'no_route_matched' end as error"
    ),
    "q_rules_table": buckets(bucket(TEXT)),
    "q_rules_refresh": buckets(
        f"case when source_topic = 'raw-a' then {bucket(TEXT)} else {SWAPPED} end"
    ),
    "q_error_reason": of_messages("event_id, error"),
    "q_error_reason_message": of_messages(f"event_id, {MESSAGE_TEXT} as error"),
    "q_error_reason_reader": of_messages(f"event_id, {READER_TEXT} as error"),
    "q_errors_out": of_messages(BRANCH, "error is not null"),
    "q_valid_out": of_messages(BRANCH, "error is null"),
    "q_routed_all": of_messages(f"event_id, key_hex, value_hex, {TOPIC} as topic, error"),
    "q_value_unchanged": of_messages("event_id, value_hex"),
    "q_split_counts": f"""{MESSAGES}
        select case when error is null then 'valid' else 'error' end as branch, count(*) as n
        from m group by 1""",
    "q_multi_topic": of_messages(f"event_id, source_topic, {TOPIC} as topic"),
    "q_from_offsets": of_messages("event_id, source_topic", "source_topic = 'raw-b' or event_id >= 400"),
    "q_from_timestamps": """
        with s as (select (epoch_ms(min(ts)) + epoch_ms(max(ts))) // 2 as middle from events)
        select event_id, if(event_id % 2 = 0, 'raw-a', 'raw-b') as source_topic from events, s
        where event_id % 2 = 1 or event_id >= (
            select min(event_id) from events, s where event_id % 2 = 0 and epoch_us(ts) >= middle * 1000)""",
    "q_offset_gaps": """
        with kept as (
          select event_id, if(event_id % 2 = 0, 'raw-a', 'raw-b') as source_topic from events
          where (event_id // 50) % 7 <> 3 and event_id % 97 <> 5),
        n as (select *, lead(event_id) over (partition by source_topic order by event_id) as b from kept)
        select source_topic, 0 as partition, event_id + 1 as first_missing, b - 1 as last_missing,
               b - event_id - 1 as missing
        from n where b > event_id + 1""",
    "q_per_message_router": of_messages(f"event_id, {TOPIC} as topic, {MESSAGE_TEXT} as error"),
    "q_one_schema_router": f"""{MESSAGES},
        r as (select event_id, {ALL_AS_7_ERROR} as code from m)
        select event_id, case when code is null then 'route_rest' else 'errors' end as topic,
               case code when 'empty_value' then 'wire_error: empty_value'
                         when 'decode_failed' then 'from_avro_failed' end as error
        from r""",
    "q_stream_route": of_messages(f"event_id, {TOPIC} as topic"),
    "q_stream_resume": of_messages(f"event_id, {TOPIC} as topic"),
    "q_foreachbatch": of_messages(f"event_id, {TOPIC} as topic"),
    "q_rules_replay": of_messages(
        f"event_id, case when error is null then {bucket(TEXT)} end as bucket, "
        "case when source_topic = 'raw-a' then 2 else 1 end as attempts",
        "source_topic = 'raw-a'",
    )
    + " union all "
    + "select event_id, case when error is null then "
    + f"{SWAPPED} end as bucket, 1 as attempts from m where source_topic = 'raw-b'",
    "q_late_schema": of_messages(
        f"event_id, case when s <> 9 or event_id % 4 < 3 then {TOPIC} end as topic, "
        "case when s <> 9 or event_id % 4 < 3 then error end as error, "
        "case when s = 3 and event_id % 4 = 0 then 1 when s <> 9 then event_id % 4 "
        "when event_id % 4 < 2 then 2 when event_id % 4 = 2 then 3 end as batch_id"
    ),
    "q_matched_replay": of_messages(
        "event_id, source_topic, key_hex, schema_id, phone as route_value, "
        f"{bucket(TEXT)} as bucket, {TOPIC} as topic, 1 as n",
        "error is null",
    ),
    "q_matched_table": of_messages(
        "event_id, source_topic, key_hex, schema_id, phone as route_value, "
        f"{bucket(TEXT)} as bucket, {TOPIC} as topic",
        "error is null",
    ),
    "q_fallback_files": of_messages(
        f"event_id, {TOPIC} as topic, "
        f"case when {MESSAGE_SIZE} > 180 then 'fallback' else 'out' end as sink"
    ),
    "q_stream_counts": f"""{MESSAGES},
        r as (select {TOPIC} as topic, error from m)
        select name, n from (
          select 'total' as name, count(*) as n from r
          union all
          select names.name, count(r.topic) from
            (values ('route_ru'), ('route_ua'), ('route_rest'), ('errors')) names(name)
            left join r on r.topic = names.name group by names.name
          union all
          select names.name, count(r.error) from
            (values ('empty_value'), ('bad_wire_header'), ('unknown_schema'),
                    ('no_default_schema'), ('decode_failed'), ('no_route_matched')) names(name)
            left join r on r.error = names.name group by names.name) counted""",
    "q_routing_summary": f"""{MESSAGES}
        select {TOPIC} as topic, error, count(*) as n from m group by 1, 2""",
}

ORACLE["q_batch_counts"] = ORACLE["q_stream_counts"]
ORACLE["q_decode_joined_registry"] = ORACLE["q_decode_large_registry"]
