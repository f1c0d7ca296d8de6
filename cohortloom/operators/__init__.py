"""DataFrame -> DataFrame operators. None collects a group, none cross joins."""
