"""starmart: a PySpark-native builder for a retail star schema."""

from starmart.config import Calendar, MartConfig
from starmart.session import get_or_create_spark_session

__all__ = ["Calendar", "MartConfig", "get_or_create_spark_session"]
