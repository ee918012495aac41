"""Names of namespaces."""

# The canonical names of namespace numbers and of their other names.
NAMESPACES = {
    "0": "", "-2": "Media", "-1": "Special", "1": "Talk", "2": "User", "3": "User talk", "4": "Project", "6": "File", "8": "MediaWiki",
    "10": "Template", "12": "Help", "14": "Category", "828": "Module",
    "user": "User", "用户": "User", "user talk": "User talk", "用户讨论": "User talk", "file": "File", "文件": "File", "file talk": "File talk",
    "image": "File", "template": "Template", "模板": "Template", "template talk": "Template talk", "help": "Help", "帮助": "Help",
    "category": "Category", "分类": "Category", "module": "Module", "模块": "Module", "project": "Project", "media": "Media", "special": "Special",
}
