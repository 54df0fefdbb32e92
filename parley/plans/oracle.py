"""Oracle SQL (DuckDB) for the registered queries.

Each text starts with the fixture views it needs (``with_views``) and aliases
every computed column to the name the Spark query uses. Queries without an
entry are approximate (``*_approx``): the driver checks their row count only.
"""

from __future__ import annotations

from parley import catalog as K
from parley.plans import registry as Q
from parley.plans.oracle_views import with_views

_MODELS_LISTED = "(" + ",".join(f"'{m}'" for m in K.AVAILABLE_MODELS) + ")"


def _outcome(x: str) -> str:
    return (f"CASE {x} " + " ".join(f"WHEN '{text}' THEN '{kind}'" for text, kind in K.OUTCOME_TEXTS)
            + f" ELSE '{K.OUTCOME_OK}' END")


def _ts(v: str) -> str:
    return f"TIMESTAMP '{v}'"


def _provider(x: str) -> str:
    return (f"CASE WHEN contains({x},'gpt') THEN 'openai' WHEN contains({x},'claude') THEN 'anthropic' "
            f"WHEN contains({x},'mistral') THEN 'mistral' ELSE 'openai' END")


def _effective(x: str) -> str:
    m = f"COALESCE(NULLIF({x},''),'gpt-3.5-turbo')"
    return (f"CASE WHEN contains({m},'gpt') OR contains({m},'claude') OR contains({m},'mistral') "
            f"THEN {m} ELSE 'gpt-3.5-turbo' END")


def _title(x: str) -> str:
    return f"CASE WHEN length({x}) > 50 THEN concat(substring({x},1,47),'...') ELSE {x} END"


_USERS_N = ("SELECT id, email, name, provider, CAST(NULL AS VARCHAR) AS provider_id, subscription_tier, "
            "subscription_expires_at, default_model, preferences, is_active, created_at, created_at AS updated_at FROM users")
_CHATS_N = ("SELECT conversation_id, user_id, title, ai_model, CAST(NULL AS VARCHAR) AS metadata, is_active, "
            "created_at, last_message_at, created_at AS updated_at FROM chats")

_REG_REASONS = """concat_ws(';',
  CASE WHEN name IS NULL THEN 'name missing' END,
  CASE WHEN length(name) < 2 THEN 'name shorter than 2' END,
  CASE WHEN length(name) > 50 THEN 'name longer than 50' END,
  CASE WHEN email IS NULL THEN 'email missing' END,
  CASE WHEN NOT regexp_matches(email, '^[^\\s@]+@[^\\s@]+\\.[^\\s@]+$') THEN 'email malformed' END,
  CASE WHEN password IS NULL THEN 'password missing' END,
  CASE WHEN length(password) < 6 THEN 'password shorter than 6' END,
  CASE WHEN length(password) > 100 THEN 'password longer than 100' END)"""

_TRIM = (r"\A[\t\n\x{0B}\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]+"
         r"|[\t\n\x{0B}\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]+\z")

_HISTORY = ("h AS (SELECT *, row_number() OVER (PARTITION BY conversation_id ORDER BY created_at, message_id) AS n "
            "FROM messages)")

_EXCHANGES = """x AS (SELECT conversation_id, message_id AS user_message_id, created_at AS user_at,
  CASE WHEN nrole='assistant' THEN nid END AS reply_message_id,
  CASE WHEN nrole='assistant' THEN nat END AS reply_at,
  CASE WHEN nrole='assistant' THEN nmodel END AS reply_model
 FROM (SELECT *, lead(message_id) OVER w AS nid, lead(role) OVER w AS nrole, lead(created_at) OVER w AS nat,
         lead(ai_model) OVER w AS nmodel
       FROM messages WINDOW w AS (PARTITION BY conversation_id ORDER BY created_at, message_id)) t
 WHERE role='user')"""

_INTERVALS = """mem AS (SELECT conversation_id, client_id, kind, ts, event_id,
   lead(ts) OVER w AS next_ts, lead(event_id) OVER w AS next_id
 FROM room_events WHERE kind IN ('join','leave')
 WINDOW w AS (PARTITION BY conversation_id, client_id ORDER BY ts, event_id))"""


def _deliveries(kinds: str, exclude_sender: bool) -> str:
    extra = " AND j.client_id <> m.client_id" if exclude_sender else ""
    return f"""SELECT m.event_id, m.conversation_id, m.client_id AS sender_id, j.client_id AS recipient_id, m.kind, m.ts
 FROM room_events m JOIN mem j ON j.conversation_id = m.conversation_id AND j.kind = 'join'
  AND (j.ts < m.ts OR (j.ts = m.ts AND j.event_id < m.event_id))
  AND (j.next_ts IS NULL OR m.ts < j.next_ts OR (m.ts = j.next_ts AND m.event_id < j.next_id)){extra}
 WHERE m.kind IN {kinds}"""


def _latest(kinds: str, want: str) -> str:
    return f"""SELECT conversation_id, client_id, ts AS since FROM (
  SELECT *, row_number() OVER (PARTITION BY conversation_id, client_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM room_events WHERE kind IN {kinds}) t WHERE rn = 1 AND kind = '{want}'"""


def _pct(col: str, p: float, alias: str) -> str:
    return f"round(quantile_cont({col}, {p}), 6) AS {alias}"


def _prices_values() -> str:
    rows = ", ".join(f"('{m}', '{t}', {p})" for m, t, p in Q.price_rows())
    return f"prices(model, tier, usd_per_1m) AS (VALUES {rows})"


def _register_sql(rejected: bool) -> str:
    base = f"""u AS ({_USERS_N}),
 chk AS (SELECT *, {_REG_REASONS} AS reasons FROM registrations),
 valid AS (SELECT * FROM chk WHERE reasons = ''),
 firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY email ORDER BY ts, reg_id) AS rn FROM valid) t WHERE rn = 1)"""
    if rejected:
        body = f"""{base}
SELECT reg_id, email, reasons FROM chk WHERE reasons <> ''
UNION ALL SELECT reg_id, email, 'email repeated in batch' FROM valid WHERE reg_id NOT IN (SELECT reg_id FROM firsts)
UNION ALL SELECT reg_id, email, 'email already registered' FROM firsts WHERE email IN (SELECT email FROM u)"""
    else:
        body = f"""{base}
SELECT * FROM u
UNION ALL SELECT reg_id AS id, email, name, 'email' AS provider, CAST(NULL AS VARCHAR) AS provider_id,
  'free' AS subscription_tier, CAST(NULL AS TIMESTAMP) AS subscription_expires_at, 'gpt-3.5-turbo' AS default_model,
  CAST(NULL AS VARCHAR) AS preferences, true AS is_active, ts AS created_at, ts AS updated_at
 FROM firsts WHERE email NOT IN (SELECT email FROM u)"""
    return with_views("," + body, "users", "registrations").replace("\n,", ",\n", 1)


#: Patchable fields that the fixture's patches carry.
_MERGED = ("name", "email", "default_model", "preferences")


def _patch_sql(rejected: bool) -> str:
    ctes = f"""u AS ({_USERS_N}),
 p AS (SELECT pp.*, u1.id IS NOT NULL AS known, u2.id AS owner FROM profile_patches pp
       LEFT JOIN u u1 ON u1.id = pp.user_id LEFT JOIN u u2 ON u2.email = pp.email),
 q AS (SELECT *, concat_ws(';',
         CASE WHEN len(list_filter(fields, lambda f: f NOT IN ('name','email','default_model','preferences','provider','provider_id'))) > 0
              THEN 'field not patchable' END,
         CASE WHEN NOT known THEN 'user not found' END,
         CASE WHEN list_contains(fields,'email') AND email IS NULL THEN 'email missing' END,
         CASE WHEN list_contains(fields,'email') AND NOT regexp_matches(email, '^[^\\s@]+@[^\\s@]+\\.[^\\s@]+$') THEN 'email malformed' END,
         CASE WHEN list_contains(fields,'name') AND name IS NULL THEN 'name missing' END,
         CASE WHEN list_contains(fields,'email') AND owner IS NOT NULL AND owner <> user_id THEN 'email taken' END) AS first_reasons
       FROM p),
 claim AS (SELECT email, user_id AS claimer FROM (SELECT email, user_id, row_number() OVER (PARTITION BY email ORDER BY ts, patch_id) AS rn
       FROM q WHERE first_reasons = '' AND list_contains(fields,'email')) t WHERE rn = 1),
 r AS (SELECT q.*, CASE WHEN first_reasons = '' AND list_contains(fields,'email')
                             AND EXISTS (SELECT 1 FROM claim WHERE claim.email = q.email AND claimer <> q.user_id)
                        THEN 'email repeated in batch' ELSE first_reasons END AS reasons FROM q),
 touched AS (SELECT DISTINCT user_id FROM r WHERE reasons = '')""" + "".join(f""",
 last_{c} AS (SELECT user_id, {c} FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, patch_id DESC) AS rn
       FROM r WHERE reasons = '' AND list_contains(fields,'{c}')) t WHERE rn = 1)""" for c in _MERGED)
    if rejected:
        body = "SELECT patch_id, user_id, reasons FROM r WHERE reasons <> ''"
    else:
        def f(c):
            return f"CASE WHEN last_{c}.user_id IS NOT NULL THEN last_{c}.{c} ELSE u.{c} END AS {c}"
        body = f"""SELECT u.id, {f('email')}, {f('name')}, u.provider, u.provider_id, u.subscription_tier,
  u.subscription_expires_at, {f('default_model')}, {f('preferences')}, u.is_active, u.created_at,
  CASE WHEN touched.user_id IS NOT NULL THEN {_ts(Q.CHANGE_AS_OF)} ELSE u.updated_at END AS updated_at
 FROM u LEFT JOIN touched ON touched.user_id = u.id {" ".join(f"LEFT JOIN last_{c} ON last_{c}.user_id = u.id" for c in _MERGED)}"""
    return with_views("," + ctes + "\n" + body, "users", "profile_patches").replace("\n,", ",\n", 1)


def _with(extra_ctes: str, body: str, *views: str) -> str:
    """Views plus our own CTEs."""
    return with_views("," + extra_ctes + "\n" + body, *views).replace("\n,", ",\n", 1)


ORACLE: dict[str, str] = {
    "chat_list": _with(f"""ft AS (SELECT conversation_id, {_title('content')} AS cand FROM (
   SELECT *, row_number() OVER (PARTITION BY conversation_id ORDER BY created_at, message_id) AS rn
   FROM messages WHERE role='user' AND content <> 'New Conversation' AND content <> '') t WHERE rn = 1),
 la AS (SELECT conversation_id, max(created_at) AS last_message_at FROM messages WHERE role='assistant' GROUP BY 1),
 lp AS (SELECT conversation_id, content AS last_message, role AS last_role FROM (
   SELECT *, row_number() OVER (PARTITION BY conversation_id ORDER BY created_at DESC, message_id DESC) AS rn FROM messages) t WHERE rn = 1),
 c AS (SELECT ch.conversation_id, ch.user_id,
   CASE WHEN (ch.title IS NULL OR ch.title = '' OR ch.title = 'New Conversation') AND ft.cand IS NOT NULL THEN ft.cand ELSE ch.title END AS title,
   ch.ai_model, ch.is_active, ch.created_at, la.last_message_at, lp.last_message, lp.last_role
   FROM chats ch LEFT JOIN ft USING (conversation_id) LEFT JOIN la USING (conversation_id) LEFT JOIN lp USING (conversation_id)
   WHERE ch.is_active)""",
        """SELECT *, 1 AS page, 20 AS "limit", (SELECT count(*) FROM c) AS total,
  CAST(ceil((SELECT count(*) FROM c) / 20) AS BIGINT) AS pages
 FROM c ORDER BY last_message_at DESC NULLS LAST, conversation_id DESC LIMIT 20""", "messages", "chats"),
    # 2.1
    "load_users": with_views(_USERS_N, "users"),
    "load_conversations": with_views(_CHATS_N, "chats"),
    "load_messages": with_views("SELECT * FROM messages", "messages"),
    "export_conversations": _with("""ms AS (SELECT conversation_id,
   list({'role': role, 'content': content, 'timestamp': strftime(created_at, '%Y-%m-%dT%H:%M:%S.%g')}
        ORDER BY created_at, message_id) AS msgs FROM messages GROUP BY conversation_id)""",
        """SELECT c.conversation_id, CAST(0 AS BIGINT) AS part, CAST(to_json({'id': c.conversation_id, 'title': c.title, 'model': c.ai_model,
   'messages': COALESCE(ms.msgs, [])}) AS VARCHAR) AS json
 FROM chats c LEFT JOIN ms USING (conversation_id)""", "messages", "chats"),
    "export_conversations_parts": _with(f"""ms AS (SELECT conversation_id, part,
   list({{'role': role, 'content': content, 'timestamp': strftime(created_at, '%Y-%m-%dT%H:%M:%S.%g')}}
        ORDER BY created_at, message_id) AS msgs FROM (SELECT *, (row_number() OVER (PARTITION BY conversation_id
          ORDER BY created_at, message_id) - 1) // {Q.EXPORT_PART} AS part FROM messages) GROUP BY conversation_id, part)""",
        """SELECT c.conversation_id, CAST(COALESCE(part, 0) AS BIGINT) AS part, CAST(to_json({'id': c.conversation_id, 'title': c.title, 'model': c.ai_model,
   'messages': COALESCE(ms.msgs, [])}) AS VARCHAR) AS json
 FROM chats c LEFT JOIN ms USING (conversation_id)""", "messages", "chats"),
    "export_pieces": with_views("""SELECT conversation_id, CAST(0 AS INT) AS section, CAST(0 AS BIGINT) AS pos,
  CAST(to_json({'id': conversation_id, 'title': title, 'model': ai_model}) AS VARCHAR)[:-2] || ',"messages":[' AS text FROM chats
 UNION ALL
 SELECT conversation_id, 1, pos, CASE WHEN pos > 1 THEN ',' ELSE '' END || CAST(to_json({'role': role, 'content': content,
   'timestamp': strftime(created_at, '%Y-%m-%dT%H:%M:%S.%g')}) AS VARCHAR)
 FROM (SELECT *, row_number() OVER (PARTITION BY conversation_id ORDER BY created_at, message_id) AS pos FROM messages) t
 WHERE conversation_id IN (SELECT conversation_id FROM chats)
 UNION ALL SELECT conversation_id, 2, 0, ']}' FROM chats""", "messages", "chats"),
    # 2.2
    "active_conversations_of_user": with_views(f"SELECT * FROM chats WHERE is_active AND user_id = {Q.ONE_USER}", "chats"),
    "public_profile": with_views("SELECT id, email, name, subscription_tier, default_model, preferences, created_at FROM users", "users"),
    "lookup_users": with_views("SELECT * FROM users WHERE id IN (SELECT user_id FROM requests)", "users", "requests"),
    "lookup_users_by_email": with_views("SELECT * FROM users WHERE email IN (SELECT email FROM registrations)",
                                        "users", "registrations"),
    "owned_conversations": with_views("""SELECT * FROM chats c WHERE EXISTS (SELECT 1 FROM room_events e
 WHERE e.conversation_id = c.conversation_id AND e.client_id % 37 = c.user_id)""", "chats", "room_events"),
    "active_conversations": with_views("SELECT * FROM chats WHERE is_active", "chats"),
    "conversation_list": with_views("SELECT conversation_id AS id, title, ai_model AS model, last_message_at AS last_message FROM chats", "chats"),
    "history_view": with_views("SELECT conversation_id, role, content, created_at AS timestamp FROM messages", "messages"),
    "search_messages": with_views(f"""SELECT * FROM messages WHERE created_at >= {_ts(Q.SEARCH['since'])}
 AND created_at < {_ts(Q.SEARCH['until'])} AND contains(lower(content), '{Q.SEARCH['text']}')""", "messages"),
    "retention_keep": with_views(f"SELECT * FROM messages WHERE created_at >= {_ts(Q.RETENTION_AS_OF)} - INTERVAL {Q.RETENTION_DAYS} DAY", "messages"),
    "retention_drop": with_views(f"SELECT * FROM messages WHERE created_at < {_ts(Q.RETENTION_AS_OF)} - INTERVAL {Q.RETENTION_DAYS} DAY", "messages"),
    "changes_since": with_views(f"""SELECT conversation_id, message_id, user_id, role, content, ai_model, created_at, token_count FROM (
  SELECT *, row_number() OVER (PARTITION BY conversation_id ORDER BY created_at DESC, message_id DESC) AS rn
  FROM messages WHERE created_at > {_ts(Q.SYNC_CURSOR)}) t WHERE rn = 1""", "messages"),
    # 2.3
    "validate_registrations": with_views(f"""SELECT reg_id, email, reasons = '' AS is_valid, reasons FROM (
  SELECT reg_id, email, {_REG_REASONS} AS reasons FROM registrations) t""", "registrations"),
    "validate_logins": with_views("""SELECT reg_id, concat_ws(';',
  CASE WHEN email IS NULL THEN 'email missing' END,
  CASE WHEN NOT regexp_matches(email, '^[^\\s@]+@[^\\s@]+\\.[^\\s@]+$') THEN 'email malformed' END,
  CASE WHEN password IS NULL THEN 'password missing' END,
  CASE WHEN length(password) < 6 THEN 'password shorter than 6' END) AS reasons FROM registrations""", "registrations"),
    "validate_messages": with_views("""SELECT message_id, concat_ws(';',
  CASE WHEN content IS NULL THEN 'content missing' END,
  CASE WHEN length(content) < 1 THEN 'content shorter than 1' END,
  CASE WHEN role IS NULL OR role NOT IN ('user','assistant','system') THEN 'role not one of user,assistant,system' END,
  CASE WHEN conversation_id IS NULL THEN 'conversation_id missing' END,
  CASE WHEN user_id IS NULL THEN 'user_id missing' END) AS reasons FROM messages""", "messages"),
    "apply_defaults": with_views("""SELECT conversation_id, user_id, title, COALESCE(ai_model, 'gpt-3.5-turbo') AS ai_model,
  COALESCE(is_active, true) AS is_active, created_at, last_message_at, '{}' AS metadata FROM chats""", "chats"),
    "clean_input": with_views(f"""SELECT message_id, content FROM (
  SELECT message_id, regexp_replace(content, '{_TRIM}', '', 'g') AS content FROM messages) t WHERE length(content) > 0""", "messages"),
    # 2.9
    "title_of": with_views(f"SELECT message_id, {_title('content')} AS title FROM messages WHERE role='user'", "messages"),
    "effective_model": with_views(f"SELECT conversation_id, ai_model, {_effective('ai_model')} AS effective_model FROM chats", "chats"),
    "provider_of": with_views(f"SELECT conversation_id, ai_model, {_provider('ai_model')} AS provider FROM chats", "chats"),
    "outcome_of": with_views(f"""SELECT message_id, {_outcome('content')} AS outcome FROM responses""", "responses"),
    "relative_age": with_views(f"""SELECT message_id, CASE
  WHEN s >= 86400 THEN CAST(s // 86400 AS VARCHAR) || 'd ago'
  WHEN s >= 3600 THEN CAST(s // 3600 AS VARCHAR) || 'h ago'
  WHEN s >= 60 THEN CAST(s // 60 AS VARCHAR) || 'm ago' ELSE 'Just now' END AS age
 FROM (SELECT message_id, (epoch_us({_ts(Q.AGE_AS_OF)}) - epoch_us(created_at)) // 1000000 AS s FROM messages) t""", "messages"),
    "initial_of": with_views("SELECT conversation_id, COALESCE(substring(ai_model, 1, 1), 'AI') AS initial FROM chats", "chats"),
    "preference": with_views("""SELECT id, json_extract_string(preferences, '$.theme') AS theme,
  TRY_CAST(json_extract(preferences, '$.notifications') AS BOOLEAN) AS notifications FROM users""", "users"),
    # 2.4
    "conform": with_views("""SELECT message_id, CAST(NULL AS BIGINT) AS conversation_id,
  CASE WHEN user_id % 5 <> 0 THEN user_id END AS user_id, role, content, CAST(NULL AS VARCHAR) AS ai_model, created_at, token_count
 FROM messages""", "messages"),
    "visible_messages_of_user": with_views(f"""SELECT m.*, c.user_id AS owner_id FROM messages m JOIN chats c USING (conversation_id)
 WHERE c.user_id = {Q.ONE_USER}""", "messages", "chats"),
    "known_logins": with_views("SELECT reg_id, email, ts FROM registrations WHERE email IN (SELECT email FROM users)", "registrations", "users"),
    "unknown_logins": with_views("SELECT reg_id, email, ts FROM registrations WHERE email NOT IN (SELECT email FROM users)", "registrations", "users"),
    "valid_token_requests_registered": _with("""k AS (SELECT * REPLACE (CASE WHEN kind = 'call' AND request_id % 17 = 0
   THEN 'register' ELSE kind END AS kind) FROM requests)""", """SELECT * FROM k c WHERE kind = 'call' AND EXISTS (SELECT 1 FROM k l
 WHERE l.kind IN ('login', 'register') AND l.user_id = c.user_id AND l.ts <= c.ts AND c.ts < l.ts + INTERVAL 7 DAY)""", "requests"),
    "visible_messages": with_views("SELECT m.*, c.user_id AS owner_id FROM messages m JOIN chats c USING (conversation_id)", "messages", "chats"),
    "orphan_messages": with_views("""SELECT * FROM messages m WHERE NOT EXISTS (SELECT 1 FROM chats c
 WHERE c.conversation_id = m.conversation_id AND c.user_id = m.user_id)""", "messages", "chats"),
    "orphan_sends": with_views("""SELECT * FROM (SELECT event_id AS message_id, conversation_id, client_id AS user_id, ts AS created_at
  FROM room_events WHERE kind = 'message') m WHERE NOT EXISTS (SELECT 1 FROM chats c
 WHERE c.conversation_id = m.conversation_id AND c.user_id = m.user_id)""", "room_events", "chats"),
    "with_conversation_model": with_views(f"""SELECT m.*, c.ai_model AS conversation_model,
  {_effective('c.ai_model')} AS sent_model, {_provider(_effective('c.ai_model'))} AS provider
 FROM messages m JOIN chats c USING (conversation_id)""", "messages", "chats"),
    "new_registrations": with_views("SELECT * FROM registrations r WHERE NOT EXISTS (SELECT 1 FROM users u WHERE u.email = r.email)",
                                    "registrations", "users"),
    "known_requests": with_views("SELECT * FROM requests WHERE user_id IN (SELECT id FROM users)", "requests", "users"),
    "unknown_requests": with_views("SELECT * FROM requests WHERE user_id NOT IN (SELECT id FROM users)", "requests", "users"),
    "valid_token_requests": with_views("""SELECT * FROM requests c WHERE kind = 'call' AND EXISTS (SELECT 1 FROM requests l
 WHERE l.kind = 'login' AND l.user_id = c.user_id AND l.ts <= c.ts AND c.ts < l.ts + INTERVAL 7 DAY)""", "requests"),
    "expired_token_requests": with_views("""SELECT * FROM requests c WHERE kind = 'call' AND NOT EXISTS (SELECT 1 FROM requests l
 WHERE l.kind = 'login' AND l.user_id = c.user_id AND l.ts <= c.ts AND c.ts < l.ts + INTERVAL 7 DAY)""", "requests"),
    "fan_out": _with(_INTERVALS, "SELECT event_id, conversation_id, sender_id, recipient_id, ts FROM ("
                     + _deliveries("('message')", False) + ") d", "room_events"),
    "typing_fan_out": _with(_INTERVALS, f"""SELECT event_id, conversation_id, sender_id, recipient_id, ts, kind = 'typing_on' AS is_typing
 FROM ({_deliveries("('typing_on','typing_off')", True)}) d""", "room_events"),
    "entitlement_violations": _with(f"""o AS (SELECT c.conversation_id, c.user_id, c.ai_model, u.subscription_tier, u.subscription_expires_at,
   CASE WHEN u.subscription_tier IN ('premium','enterprise') AND u.subscription_expires_at IS NOT NULL
        AND u.subscription_expires_at <= {_ts(Q.ENTITLEMENT_AS_OF)} THEN 'free' ELSE u.subscription_tier END AS effective_tier
   FROM chats c JOIN users u ON u.id = c.user_id WHERE c.ai_model IN ('gpt-4'))""",
        "SELECT * FROM o WHERE effective_tier = 'free'", "chats", "users"),
    "with_catalogue": with_views(f"""SELECT *, {_provider('ai_model')} AS provider,
  COALESCE(ai_model IN {_MODELS_LISTED}, false) AS listed, COALESCE(ai_model = 'gpt-4', false) AS premium FROM chats""", "chats"),
    # 2.5
    "prompt_context": _with(_HISTORY, """SELECT t.conversation_id, t.message_id, c.n - 1 AS pos, c.role, c.content
 FROM h t JOIN h c ON c.conversation_id = t.conversation_id AND c.n <= t.n WHERE t.role = 'user'""", "messages"),
    "prompt_context_window": _with(_HISTORY, f"""SELECT t.conversation_id, t.message_id, c.n - greatest(1, t.n - {Q.PROMPT_TURNS - 1}) AS pos,
  c.role, c.content
 FROM h t JOIN h c ON c.conversation_id = t.conversation_id AND c.n <= t.n AND c.n >= greatest(1, t.n - {Q.PROMPT_TURNS - 1})
 WHERE t.role = 'user'""", "messages"),
    "prompt_chunks": _with(_HISTORY, f"""SELECT conversation_id, (n - 1) // {Q.PROMPT_CHUNK} AS chunk, count(*) AS n_messages,
  CAST(to_json(list({{'role': role, 'content': content}} ORDER BY n)) AS VARCHAR) AS messages FROM h GROUP BY 1, 2""", "messages"),
    "prompt_chunk_turns": _with(_HISTORY, f"""SELECT conversation_id, message_id, n // {Q.PROMPT_CHUNK} AS whole_chunks, n % {Q.PROMPT_CHUNK} AS tail
 FROM h WHERE role = 'user'""", "messages"),
    "prompt_context_expanded": _with(_HISTORY, """SELECT t.conversation_id, t.message_id, c.n - 1 AS pos, c.role, c.content
 FROM h t JOIN h c ON c.conversation_id = t.conversation_id AND c.n <= t.n WHERE t.role = 'user'""", "messages"),
    "prompt_ranges": _with(_HISTORY, f"""SELECT conversation_id, message_id, greatest(1, n - {Q.PROMPT_TURNS - 1}) AS first_ordinal,
  n AS last_ordinal FROM h WHERE role = 'user'""", "messages"),
    "derive_titles": _with(f"""ft AS (SELECT conversation_id, {_title('content')} AS cand FROM (
   SELECT *, row_number() OVER (PARTITION BY conversation_id ORDER BY created_at, message_id) AS rn
   FROM messages WHERE role='user' AND content <> 'New Conversation' AND content <> '') t WHERE rn = 1)""",
        """SELECT c.conversation_id, c.user_id,
  CASE WHEN (c.title IS NULL OR c.title = '' OR c.title = 'New Conversation') AND ft.cand IS NOT NULL THEN ft.cand ELSE c.title END AS title,
  c.ai_model, c.is_active, c.created_at, c.last_message_at
 FROM chats c LEFT JOIN ft USING (conversation_id)""", "messages", "chats"),
    "last_activity": with_views("SELECT conversation_id, max(created_at) AS last_message_at FROM messages WHERE role='assistant' GROUP BY 1", "messages"),
    "last_preview": with_views("""SELECT conversation_id, content AS last_message, role AS last_role, created_at AS last_message_at FROM (
  SELECT *, row_number() OVER (PARTITION BY conversation_id ORDER BY created_at DESC, message_id DESC) AS rn FROM messages) t
 WHERE rn = 1""", "messages"),
    "outcome_rates": _with(f"""o AS (SELECT {_effective('ai_model')} AS model, {_outcome('content')} AS oc FROM responses)""",
        f"""SELECT model, {_provider('model')} AS provider, count(*) AS replies,
  count(*) FILTER (WHERE oc='error') AS error, count(*) FILTER (WHERE oc='unconfigured') AS unconfigured,
  count(*) FILTER (WHERE oc='mock') AS mock, count(*) FILTER (WHERE oc='empty') AS empty,
  count(*) FILTER (WHERE oc='ok') AS ok, round(count(*) FILTER (WHERE oc='ok') / count(*), 6) AS ok_rate
 FROM o GROUP BY model""", "responses"),
    "usage_daily": with_views("""SELECT user_id, ai_model, strftime(CAST(created_at AS DATE), '%Y-%m-%d') AS day, count(*) AS messages,
  count(DISTINCT conversation_id) AS conversations, CAST(sum(token_count) AS BIGINT) AS tokens
 FROM messages GROUP BY 1, 2, 3""", "messages"),
    "usage_bill": _with(f"""{_prices_values()},
 ud AS (SELECT user_id, ai_model, CAST(created_at AS DATE) AS day, CAST(sum(token_count) AS BIGINT) AS tokens
   FROM messages GROUP BY 1, 2, 3),
 j AS (SELECT ud.user_id, u.subscription_tier AS tier, ud.tokens, CAST(p.usd_per_1m AS DECIMAL(18,6)) AS price
   FROM ud LEFT JOIN users u ON u.id = ud.user_id LEFT JOIN prices p ON p.model = ud.ai_model AND p.tier = u.subscription_tier)""",
        """SELECT user_id, tier, CAST(sum(tokens) AS BIGINT) AS tokens,
  CAST(sum(CASE WHEN price IS NOT NULL THEN tokens ELSE 0 END) AS BIGINT) AS billed_tokens,
  CAST(CAST(COALESCE(sum(CAST(tokens AS DECIMAL(18,0)) * price), 0) * CAST(0.000001 AS DECIMAL(18,6)) AS DECIMAL(18,6)) AS DOUBLE) AS amount_usd
 FROM j GROUP BY 1, 2""", "messages", "users"),
    "active_users": with_views("SELECT strftime(CAST(created_at AS DATE), '%Y-%m-%d') AS day, count(DISTINCT user_id) AS active_users FROM messages GROUP BY 1", "messages"),
    "user_breakdown": with_views("""SELECT provider, subscription_tier, count(*) AS users,
  CAST(GROUPING(provider) AS INT) AS g_provider, CAST(GROUPING(subscription_tier) AS INT) AS g_tier
 FROM users GROUP BY CUBE (provider, subscription_tier)""", "users"),
    "latency_stats": with_views(f"""SELECT kind, count(response_ms) AS requests, round(avg(response_ms), 6) AS mean_ms,
  round(count(*) FILTER (WHERE response_ms < 200.0) / count(response_ms), 6) AS share_under_limit,
  {_pct('response_ms', 0.5, 'p50_ms')}, {_pct('response_ms', 0.95, 'p95_ms')}, {_pct('response_ms', 0.99, 'p99_ms')}
 FROM requests GROUP BY kind""", "requests"),
    "active_users_rollup_check": with_views("""SELECT strftime(date_trunc('month', created_at), '%Y-%m-%d') AS period,
  count(DISTINCT CAST(created_at AS DATE)) AS days, count(DISTINCT user_id) AS exact, true AS close FROM messages GROUP BY 1""", "messages"),
    "latency_rollup_check": with_views("""SELECT kind, count(response_ms) AS requests, round(avg(response_ms), 6) AS mean_ms,
  round(count(*) FILTER (WHERE response_ms < 200.0) / count(response_ms), 6) AS share_under_limit,
  true AS p50_close, true AS p95_close, true AS p99_close FROM requests GROUP BY kind""", "requests"),
    # 2.6
    "message_history": _with(_HISTORY, "SELECT message_id, conversation_id, user_id, role, content, ai_model, created_at, token_count, n AS ordinal FROM h", "messages"),
    "exchanges": _with(_EXCHANGES, "SELECT * FROM x", "messages"),
    "response_delay": _with(_EXCHANGES, """SELECT conversation_id, user_message_id, reply_message_id, reply_model,
  (epoch_us(reply_at) - epoch_us(user_at)) / 1e6 AS delay_s FROM x WHERE reply_message_id IS NOT NULL""", "messages"),
    "response_delay_by_model": _with(_EXCHANGES + """,
 d AS (SELECT reply_model, (epoch_us(reply_at) - epoch_us(user_at)) / 1e6 AS delay_s FROM x WHERE reply_message_id IS NOT NULL)""",
        f"""SELECT reply_model, count(*) AS exchanges, round(avg(delay_s), 6) AS mean_s,
  {_pct('delay_s', 0.5, 'p50_s')}, {_pct('delay_s', 0.95, 'p95_s')} FROM d GROUP BY reply_model""", "messages"),
    # 2.7
    "paginate": _with("a AS (SELECT * FROM chats WHERE is_active)", """SELECT *, 1 AS page, 20 AS "limit",
  (SELECT count(*) FROM a) AS total, CAST(ceil((SELECT count(*) FROM a) / 20) AS BIGINT) AS pages
 FROM a ORDER BY created_at DESC, conversation_id DESC LIMIT 20 OFFSET 0""", "chats"),
    "paginate_page2": _with("a AS (SELECT * FROM chats WHERE is_active)", """SELECT *, 2 AS page, 20 AS "limit",
  (SELECT count(*) FROM a) AS total, CAST(ceil((SELECT count(*) FROM a) / 20) AS BIGINT) AS pages
 FROM a ORDER BY created_at DESC, conversation_id DESC LIMIT 20 OFFSET 20""", "chats"),
    "paginate_cursor": _with("a AS (SELECT * FROM chats WHERE is_active)", f"""SELECT *, 1 AS page, 20 AS "limit",
  (SELECT count(*) FROM a) AS total, CAST(ceil((SELECT count(*) FROM a) / 20) AS BIGINT) AS pages
 FROM a WHERE last_message_at IS NULL OR last_message_at < {_ts(Q.CURSOR_AT)}
   OR (last_message_at = {_ts(Q.CURSOR_AT)} AND conversation_id < {Q.CURSOR_ID})
 ORDER BY last_message_at DESC NULLS LAST, conversation_id DESC LIMIT 20""", "chats"),
    "recent_conversations": with_views(f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id
  ORDER BY last_message_at DESC NULLS LAST, conversation_id) AS rank FROM chats) t WHERE rank <= {Q.RECENT_K}""", "chats"),
    # 2.10
    "register_users": _register_sql(False),
    "register_users_rejected": _register_sql(True),
    "patch_users": _patch_sql(False),
    "patch_users_rejected": _patch_sql(True),
    "delete_users": _with(f"u AS ({_USERS_N})", "SELECT * FROM u WHERE id NOT IN (SELECT id FROM user_deletions)",
                          "users", "user_deletions"),
    "delete_users_unknown": with_views("SELECT DISTINCT id FROM user_deletions WHERE id NOT IN (SELECT id FROM users)",
                                       "users", "user_deletions"),
    "create_conversations": with_views(f"""{_CHATS_N}
 UNION ALL SELECT conversation_id, user_id, title, COALESCE(ai_model, 'gpt-3.5-turbo') AS ai_model, '{{}}' AS metadata,
  true AS is_active, created_at, CAST(NULL AS TIMESTAMP) AS last_message_at, created_at AS updated_at
 FROM conversation_requests WHERE title IS NOT NULL""", "chats", "conversation_requests"),
    "create_conversations_rejected": with_views(
        "SELECT conversation_id, user_id, 'title missing' AS reasons FROM conversation_requests WHERE title IS NULL", "conversation_requests"),
    "conversation_updates": with_views("""SELECT conversation_id, first_content, first_message_id, last_reply_at
 FROM (SELECT conversation_id, max(CASE WHEN role = 'assistant' THEN created_at END) AS last_reply_at FROM messages GROUP BY 1) a
 LEFT JOIN (SELECT conversation_id, content AS first_content, message_id AS first_message_id FROM (
   SELECT *, row_number() OVER (PARTITION BY conversation_id ORDER BY created_at, message_id) AS rn
   FROM messages WHERE role = 'user' AND content <> 'New Conversation' AND content <> '') t WHERE rn = 1) b USING (conversation_id)""", "messages"),
    "soft_delete": _with(f"""c AS ({_CHATS_N}),
 k AS (SELECT DISTINCT conversation_id, user_id FROM delete_requests)""",
        f"""SELECT c.conversation_id, c.user_id, c.title, c.ai_model, c.metadata,
  CASE WHEN k.conversation_id IS NOT NULL THEN false ELSE c.is_active END AS is_active, c.created_at, c.last_message_at,
  CASE WHEN k.conversation_id IS NOT NULL THEN {_ts(Q.CHANGE_AS_OF)} ELSE c.updated_at END AS updated_at
 FROM c LEFT JOIN k ON k.conversation_id = c.conversation_id AND k.user_id = c.user_id""", "chats", "delete_requests"),
    "soft_delete_misses": with_views("""SELECT * FROM delete_requests r WHERE NOT EXISTS (SELECT 1 FROM chats c
 WHERE c.conversation_id = r.conversation_id AND c.user_id = r.user_id)""", "chats", "delete_requests"),
    "refresh_conversations": _with(f"""c AS ({_CHATS_N}),
 ft AS (SELECT conversation_id, content AS first FROM (
   SELECT *, row_number() OVER (PARTITION BY conversation_id ORDER BY created_at, message_id) AS rn
   FROM messages WHERE role='user' AND content <> 'New Conversation' AND content <> '') t WHERE rn = 1),
 la AS (SELECT conversation_id, max(created_at) AS last FROM messages WHERE role='assistant' GROUP BY 1)""",
        f"""SELECT c.conversation_id, c.user_id,
  CASE WHEN la.last IS NOT NULL AND (c.title IS NULL OR c.title = '' OR c.title = 'New Conversation') AND ft.first IS NOT NULL
       THEN {_title('ft.first')} ELSE c.title END AS title,
  c.ai_model, c.metadata, c.is_active, c.created_at,
  CASE WHEN la.last IS NOT NULL THEN greatest(c.last_message_at, la.last) ELSE c.last_message_at END AS last_message_at,
  CASE WHEN la.last IS NOT NULL THEN {_ts(Q.CHANGE_AS_OF)} ELSE c.updated_at END AS updated_at
 FROM c LEFT JOIN ft USING (conversation_id) LEFT JOIN la USING (conversation_id)""", "messages", "chats"),
    # 2.11 batch twins
    "room_members": with_views(_latest("('join','leave')", "join"), "room_events"),
    "room_member_counts": with_views("SELECT conversation_id, count(*) AS members FROM ("
                                     + _latest("('join','leave')", "join") + ") t GROUP BY 1", "room_events"),
    "typing_now": with_views(_latest("('typing_on','typing_off')", "typing_on"), "room_events"),
    "fan_out_step": _with(_INTERVALS, "SELECT event_id, conversation_id, sender_id, recipient_id, ts FROM ("
                          + _deliveries("('message')", False) + f") d WHERE ts >= {_ts(Q.STEP_AT)}", "room_events"),
    "fan_out_step_members": with_views(_latest("('join','leave')", "join"), "room_events"),
    "rate_limit": with_views(f"""SELECT client_ip, window_start, window_start + INTERVAL 1 HOUR AS reset_at, requests,
  greatest({Q.RATE['limit']} - requests, 0) AS remaining, requests > {Q.RATE['limit']} AS limited
 FROM (SELECT client_ip, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS requests
       FROM requests GROUP BY 1, 2) t""", "requests"),
    "admission_step": with_views(f"""SELECT request_id, client_ip, ts, window_start, position, position <= {Q.RATE['limit']} AS accepted
 FROM (SELECT *, row_number() OVER (PARTITION BY client_ip, window_start ORDER BY ts, request_id) AS position
       FROM (SELECT *, time_bucket(INTERVAL 1 HOUR, ts) AS window_start FROM requests) a) t
 WHERE ts >= {_ts(Q.ADMIT_AT)}""", "requests"),
    "admission_step_counts": with_views(f"""SELECT client_ip, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS requests
 FROM requests WHERE ts < {_ts(Q.ADMIT_AT)} AND time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR > {_ts(Q.ADMIT_AT)} GROUP BY 1, 2""", "requests"),
    "rate_limited_requests": with_views(f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY client_ip, window_start
  ORDER BY ts, request_id) AS position FROM (SELECT *, time_bucket(INTERVAL 1 HOUR, ts) AS window_start FROM requests) a) t
 WHERE position > {Q.RATE['limit']}""", "requests"),
}
