"""DataFrame operators: conditions, joins, ranks, aggregates, evaluation, prompts, models."""
