"""Kafka sink through Spark's connector.

Options are those of the connector (``kafka.bootstrap.servers``, ``topic``,
``kafka.client.id``, ...), given as a mapping. Certificates and keys are named by
place, so no key material gets into a plan.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

# What the producer is given unless the caller says otherwise.
PRODUCER_OPTIONS = {
    "kafka.acks": "all",
    "kafka.retries": "10",
    "kafka.linger.ms": "20",
    "kafka.batch.size": "32768",
    "kafka.compression.type": "gzip",
    "kafka.max.in.flight.requests.per.connection": "5",
    "kafka.request.timeout.ms": "30000",
    "kafka.security.protocol": "PLAINTEXT",
}
NEEDED = ("kafka.bootstrap.servers", "topic")
PROTOCOLS = ("PLAINTEXT", "SSL", "SASL_PLAINTEXT", "SASL_SSL")
NEEDED_TO_LOG_IN = ("kafka.sasl.mechanism", "kafka.sasl.jaas.config")
_LOGINS = {"PLAIN": "plain.Plain", "SCRAM-SHA-256": "scram.Scram", "SCRAM-SHA-512": "scram.Scram"}


def connector_options(given: Mapping[str, str]) -> dict[str, str]:
    """The given options over the fixed ones; blank ones count as not given.

    The security protocol may be written in any case; with a login its mechanism and settings
    are needed, which :func:`login_options` makes.
    """
    options = PRODUCER_OPTIONS | {k: v.strip() for k, v in given.items() if v.strip()}
    options["kafka.security.protocol"] = protocol = options["kafka.security.protocol"].upper()
    if protocol not in PROTOCOLS:
        raise ValueError(f"no security protocol {protocol}; there are {', '.join(PROTOCOLS)}")
    needed = NEEDED + (NEEDED_TO_LOG_IN if protocol.startswith("SASL_") else ())
    missing = [k for k in needed if k not in options]
    if missing:
        raise ValueError(f"options needed by the connector: {', '.join(missing)}")
    return options


def login_options(mechanism: str, user: str, password: str, encrypted: bool = True) -> dict[str, str]:
    """Options of a login by name and password. Keep them out of logs with ``spark.redaction.regex``."""
    name = mechanism.upper()
    if name not in _LOGINS:
        raise ValueError(f"no login by {mechanism}; there are {', '.join(_LOGINS)}")
    if not user or not password:
        raise ValueError("a login has a user and a password")
    quoted = ['"' + x.replace("\\", "\\\\").replace('"', '\\"') + '"' for x in (user, password)]
    module = f"org.apache.kafka.common.security.{_LOGINS[name]}LoginModule"
    return {
        "kafka.security.protocol": "SASL_SSL" if encrypted else "SASL_PLAINTEXT",
        "kafka.sasl.mechanism": name,
        "kafka.sasl.jaas.config": f"{module} required username={quoted[0]} password={quoted[1]};",
    }


def certificate_options(trusted: str = "", own: str = "") -> dict[str, str]:
    """Options naming PEM files that every executor can read: trusted authorities, and own key with its chain."""
    options = {}
    for store, place in (("truststore", trusted), ("keystore", own)):
        if place:
            options |= {f"kafka.ssl.{store}.type": "PEM", f"kafka.ssl.{store}.location": place}
    return options


def write_kafka(messages: DataFrame, options: Mapping[str, str]) -> int:
    """Send messages (key, value); a delivery error fails the job. Gives the
    number of messages."""
    sent = Observation()
    observed = messages.observe(sent, F.count(F.lit(1)).alias("rows"))
    observed.write.format("kafka").options(**connector_options(options)).save()
    return sent.get["rows"]


def stream_to_kafka(messages: DataFrame, options: Mapping[str, str], checkpoint: str) -> DataStreamWriter:
    """Writer for a stream of messages."""
    writer = messages.writeStream.format("kafka").options(**connector_options(options))
    return writer.option("checkpointLocation", checkpoint)
