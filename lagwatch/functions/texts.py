"""Texts that published alerts carry and their readers match on."""

INACTIVE_ADVICE = "Check consumer group health, deployments, and network connectivity"
REBALANCE_CAUSE = "Consumer group rebalancing or instance restarts"
REBALANCE_ADVICE = (
    "Check for frequent pod restarts, autoscaling events, or static membership configuration"
)
LAG_SPIKE_TEXT = "Consumer lag exceeded 10K messages: "
HOT_PARTITION_ADVICE = "Review partition key distribution or scale consumer instances"
CAUSE_SHARED = "Likely producer or broker issue (most groups affected)"
CAUSE_MIXED = "Mixed issue - check both producer and consumer health"
CORRELATION_ADVICE = "Investigate topic write throughput, broker metrics, and producer health"
SAME_TOPIC = "same_topic_degradation"
SAME_TOPIC_CAUSE = "broker_or_producer_issue"
SAME_TOPIC_ADVICE = "Check broker health and producer for topic "
