"""The governed staging job over newly landed bundles only."""
