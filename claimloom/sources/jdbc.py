"""Connection options for a JDBC warehouse."""

import os
from collections.abc import Mapping


def postgres_options(config: Mapping, connections: int = 16, batch: int = 10_000) -> dict[str, str]:
    """Writer options from the `database` section of a configuration."""
    db = config["database"]
    return {
        "url": f"jdbc:postgresql://{db['host']}:{db['port']}/{db['name']}",
        "user": str(db["user"]),
        "password": str(db["password"]),
        "driver": "org.postgresql.Driver",
        "numPartitions": str(connections),
        "batchsize": str(batch),
    }


def snowflake_options(
    config: Mapping, env: Mapping[str, str] = os.environ, connections: int = 16, batch: int = 10_000
) -> dict[str, str]:
    """Writer options from the `snowflake` section; the credentials come from the environment only."""
    section = config["snowflake"]
    return {
        "url": f"jdbc:snowflake://{section['account']}.snowflakecomputing.com/",
        "user": env["SNOWFLAKE_USER"],
        "password": env["SNOWFLAKE_PASSWORD"],
        "db": section["database"],
        "schema": section["schema"],
        "warehouse": section["warehouse"],
        "role": section["role"],
        "driver": "net.snowflake.client.jdbc.SnowflakeDriver",
        "numPartitions": str(connections),
        "batchsize": str(batch),
    }
