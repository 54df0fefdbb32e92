"""DuckDB text of the fixture views, for the oracle SQL.

Only the driver tables are registered in the oracle database, so every oracle
query starts with a WITH clause built by ``with_views``. The texts mirror
``parley.sources.fixtures`` expression by expression.
"""

from __future__ import annotations

from parley import catalog as K

_MODELS = "[" + ",".join(f"'{m}'" for m in K.AVAILABLE_MODELS) + ",'llama-2',NULL]"
_REPLIES = " ".join(f"WHEN {i} THEN '{text}'" for i, (text, _) in enumerate(K.OUTCOME_TEXTS))
_T0 = "TIMESTAMP '2024-01-01 00:00:00'"


def _at(seconds: str) -> str:
    return f"({_T0} + to_seconds(CAST({seconds} AS BIGINT)))"


_MSG_SECONDS = "conv_id*3600+turn*60+length(text)%50"
_EXISTING = "concat('customer', lpad(CAST({u} AS VARCHAR), 9, '0'), '@example.com')"

VIEW_SQL = {
    "messages": f"""SELECT conv_id*1000+turn AS message_id, conv_id AS conversation_id, conv_id%37 AS user_id,
 role, text AS content,
 CASE WHEN role='assistant' THEN list_extract({_MODELS}, CAST(conv_id%8+1 AS INT)) END AS ai_model,
 {_at(_MSG_SECONDS)} AS created_at,
 CAST(len(list_filter(regexp_split_to_array(text, '[ \n\t]+'), lambda x: x<>'')) AS INT) AS token_count
 FROM conversations""",
    "chats": f"""SELECT conv_id AS conversation_id, conv_id%37 AS user_id,
 CASE conv_id%3 WHEN 0 THEN 'New Conversation' WHEN 1 THEN '' ELSE concat('Topic ', CAST(conv_id AS VARCHAR)) END AS title,
 list_extract({_MODELS}, CAST(conv_id%8+1 AS INT)) AS ai_model, conv_id%7<>0 AS is_active,
 {_at('conv_id*3600')} AS created_at,
 max(CASE WHEN role='assistant' THEN {_at(_MSG_SECONDS)} END) AS last_message_at
 FROM conversations GROUP BY conv_id""",
    "users": f"""SELECT c_custkey AS id, lower(concat(replace(c_name,'#',''),'@example.com')) AS email, c_name AS name,
 CASE c_custkey%3 WHEN 0 THEN 'email' WHEN 1 THEN 'google' ELSE 'apple' END AS provider,
 CASE WHEN c_mktsegment='MACHINERY' THEN 'enterprise' WHEN c_mktsegment IN ('BUILDING','AUTOMOBILE') THEN 'premium' ELSE 'free' END AS subscription_tier,
 CASE WHEN c_mktsegment IN ('MACHINERY','BUILDING','AUTOMOBILE') THEN {_at('(c_custkey%60)*86400')} END AS subscription_expires_at,
 list_extract({_MODELS}, CAST(c_custkey%6+1 AS INT)) AS default_model,
 CASE WHEN c_custkey%4=0 THEN NULL ELSE concat('{{"theme":"', CASE WHEN c_custkey%2=0 THEN 'dark' ELSE 'light' END,
   '","notifications":', CASE WHEN c_custkey%5=0 THEN 'false' ELSE 'true' END, '}}') END AS preferences,
 c_custkey%11<>0 AS is_active, {_at('c_custkey*60')} AS created_at
 FROM customer""",
    "room_events": """SELECT event_id, event_id%20 AS conversation_id, user_id AS client_id,
 CASE event_type WHEN 'view' THEN 'join' WHEN 'error' THEN 'leave' WHEN 'click' THEN 'typing_on'
   WHEN 'purchase' THEN 'typing_off' ELSE 'message' END AS kind, ts FROM events""",
    "requests": """SELECT event_id AS request_id, user_id%50 AS client_ip, user_id,
 CASE event_type WHEN 'signup' THEN 'login' ELSE 'call' END AS kind, ts, value AS response_ms FROM events""",
    "responses": f"""SELECT message_id, conversation_id, user_id, ai_model, created_at,
 CASE conversation_id%10 {_REPLIES}
   ELSE content END AS content
 FROM messages WHERE role='assistant'""",
    "registrations": f"""SELECT 10000000+event_id AS reg_id,
 CASE WHEN event_id%5=0 THEN 'X' ELSE concat('User ', CAST(user_id AS VARCHAR)) END AS name,
 CASE event_id%4 WHEN 0 THEN {_EXISTING.format(u='user_id')}
   WHEN 1 THEN concat('new', CAST(user_id AS VARCHAR), '@example.com')
   WHEN 2 THEN upper({_EXISTING.format(u='user_id')})
   ELSE concat('user', CAST(user_id AS VARCHAR), '.example.com') END AS email,
 repeat('p', CAST(3+event_id%9 AS INT)) AS password, 'email' AS provider, ts
 FROM events WHERE event_type='signup'""",
    "profile_patches": f"""SELECT event_id AS patch_id, user_id,
 CASE event_id%6 WHEN 0 THEN ['name'] WHEN 1 THEN ['default_model'] WHEN 2 THEN ['preferences']
   WHEN 3 THEN ['name','email'] WHEN 4 THEN ['password'] ELSE ['default_model','preferences'] END AS fields,
 CASE WHEN event_id%18<>0 THEN concat('Renamed ', CAST(event_id AS VARCHAR)) END AS name,
 CASE WHEN event_id%12=3 THEN {_EXISTING.format(u='user_id+1')}
   WHEN event_id%36=9 THEN concat('same', CAST(user_id%7 AS VARCHAR), '@example.com')
   WHEN event_id%36=21 THEN 'not-an-email' WHEN event_id%72=33 THEN NULL
   ELSE concat('moved', CAST(event_id AS VARCHAR), '@example.com') END AS email,
 CASE WHEN event_id%4=1 THEN NULL ELSE 'gpt-4' END AS default_model,
 CASE WHEN event_id%4=0 THEN '{{"theme":"dark","notifications":{{"email":true,"push":false}}}}'
   ELSE '{{"theme":"light","notifications":true}}' END AS preferences,
 'secret123' AS password, ts
 FROM events WHERE event_type='click'""",
    "user_deletions": """SELECT CASE WHEN event_id%3=0 THEN user_id+1000000 ELSE user_id END AS id, ts
 FROM events WHERE event_type='purchase'""",
    "conversation_requests": """SELECT 1000000+event_id AS conversation_id, user_id,
 CASE WHEN event_id%10<>0 THEN concat('Chat ', CAST(event_id AS VARCHAR)) END AS title,
 CASE event_id%3 WHEN 0 THEN NULL WHEN 1 THEN 'claude-3-haiku' ELSE 'gpt-4' END AS ai_model,
 ts AS created_at FROM events WHERE event_type='view'""",
    "delete_requests": """SELECT event_id%120 AS conversation_id, user_id%37 AS user_id, ts
 FROM events WHERE event_type='error'""",
}

# Views that read other views must come after them.
_DEPENDS = {"responses": ["messages"]}
_ORDER = list(VIEW_SQL)


def with_views(body: str, *names: str) -> str:
    """``WITH <views> <body>``; dependencies are added automatically."""
    need: list[str] = []

    def add(n: str) -> None:
        for d in _DEPENDS.get(n, []):
            add(d)
        if n not in need:
            need.append(n)

    for n in names:
        add(n)
    need.sort(key=_ORDER.index)
    ctes = ",\n".join(f"{n} AS ({VIEW_SQL[n]})" for n in need)
    return f"WITH {ctes}\n{body}" if ctes else body
