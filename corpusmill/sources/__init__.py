"""Sources and sinks: shards, prompt files, reports, resumable logs."""
