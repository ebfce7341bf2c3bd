"""Sources: table and file readers, message envelopes, derived inputs."""
