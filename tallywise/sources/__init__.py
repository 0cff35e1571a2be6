"""Tables, landing views, nested payloads, file readers and sinks."""
