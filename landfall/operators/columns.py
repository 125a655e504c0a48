"""Strict renaming."""


def rename_columns(df, mapping):
    """Rename by ``{old: new}``; an absent source name is an error."""
    absent = [name for name in mapping if name not in df.columns]
    if absent:
        raise ValueError(f"cannot rename absent columns {absent}; have {df.columns}")
    return df.withColumnsRenamed(mapping)
