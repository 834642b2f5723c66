"""Kafka source and sink options, and the reader."""


def source_options(config):
    """Options of the Kafka source.  Headers are always read; a start position counts only
    for a query without a checkpoint.

    By default a Kafka partition is one task, however many messages it holds.  The minimum
    number of partitions and the maximum of records per partition split large ones."""
    options = {
        "kafka.bootstrap.servers": config.bootstrap,
        "subscribe": ",".join(config.input_topics),
        "startingOffsets": config.starting_offsets,
        "failOnDataLoss": str(config.fail_on_data_loss).lower(),
        "includeHeaders": "true",
    }
    sizes = {
        "minPartitions": config.min_partitions,
        "maxRecordsPerPartition": config.max_records_per_partition,
        "maxOffsetsPerTrigger": config.max_offsets_per_trigger,
    }
    return options | {name: str(size) for name, size in sizes.items() if size}


def sink_options(config):
    """Options of the Kafka sink; the topic comes from each row."""
    return {
        "kafka.bootstrap.servers": config.bootstrap,
        "kafka.acks": config.acks,
        "kafka.max.request.size": str(config.max_request_size),
    }


def read_stream(spark, config):
    return spark.readStream.format("kafka").options(**source_options(config)).load()


def read_batch(spark, config):
    """The topics as they are now; a batch read must start at the earliest offsets."""
    options = source_options(config) | {"startingOffsets": "earliest"}
    options.pop("maxOffsetsPerTrigger", None)
    return spark.read.format("kafka").options(**options).load()
