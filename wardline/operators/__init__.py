"""DataFrame-to-DataFrame steps: staging, marts, features, gates, incremental load."""
