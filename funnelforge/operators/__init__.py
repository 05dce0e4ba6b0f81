"""DataFrame -> DataFrame transforms (staging, identity, marts, quality)."""
