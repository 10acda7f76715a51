"""Sources and sinks: table fixtures, CSV and text lines, topic/landing
folders, replay pacing, and the enriched-record sinks."""
