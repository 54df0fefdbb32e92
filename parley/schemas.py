"""Declared table shapes (snake_case) and the product's camelCase spellings."""

from __future__ import annotations

from pyspark.sql import types as T

USERS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("email", T.StringType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("provider", T.StringType()),
    T.StructField("provider_id", T.StringType()),
    T.StructField("subscription_tier", T.StringType()),
    T.StructField("subscription_expires_at", T.TimestampNTZType()),
    T.StructField("default_model", T.StringType()),
    T.StructField("preferences", T.StringType()),
    T.StructField("is_active", T.BooleanType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

CONVERSATIONS = T.StructType([
    T.StructField("conversation_id", T.LongType()),
    T.StructField("user_id", T.LongType(), False),
    T.StructField("title", T.StringType(), False),
    T.StructField("ai_model", T.StringType()),
    T.StructField("metadata", T.StringType()),
    T.StructField("is_active", T.BooleanType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("last_message_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

MESSAGES = T.StructType([
    T.StructField("message_id", T.LongType()),
    T.StructField("conversation_id", T.LongType(), False),
    T.StructField("user_id", T.LongType(), False),
    T.StructField("role", T.StringType(), False),
    T.StructField("content", T.StringType(), False),
    T.StructField("ai_model", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("token_count", T.IntegerType()),
])

ROOM_EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("conversation_id", T.LongType()),
    T.StructField("client_id", T.LongType()),
    T.StructField("kind", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
])

REQUESTS = T.StructType([
    T.StructField("request_id", T.LongType()),
    T.StructField("client_ip", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("kind", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("response_ms", T.DoubleType()),
])

# The entity declares camelCase, the DDL snake_case; Mongo documents use _id.
CAMEL_TO_SNAKE = {
    "_id": None,  # table-specific, see sources.tables
    "providerId": "provider_id",
    "subscriptionTier": "subscription_tier",
    "subscriptionExpiresAt": "subscription_expires_at",
    "defaultModel": "default_model",
    "isActive": "is_active",
    "createdAt": "created_at",
    "updatedAt": "updated_at",
    "userId": "user_id",
    "aiModel": "ai_model",
    "lastMessageAt": "last_message_at",
    "conversationId": "conversation_id",
    "tokenCount": "token_count",
}
