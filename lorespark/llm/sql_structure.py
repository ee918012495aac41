"""The SQL counterpart of p1_found: the same elements by regular expressions alone.

It covers the markup of the test tables only; what it cannot tell (nesting, unbalanced marks) the
tests of the parser do.
"""

_CODE = r"<(?:pre|source|syntaxhighlight)\b[^>]*>.*?</(?:pre|source|syntaxhighlight)\s*>|^[ \t]*```[^\n]*\n.*?^[ \t]*```[ \t]*$|^[ \t]*~~~[^\n]*\n.*?^[ \t]*~~~[ \t]*$|\\begin\{verbatim\}.*?\\end\{verbatim\}|\\begin\{lstlisting\}.*?\\end\{lstlisting\}"
_MATH = r"<math\b[^>]*>.*?</math\s*>|\$\$.+?\$\$|\\\[.+?\\\]|\\\(.+?\\\)|\\begin\{equation\*?\}.+?\\end\{equation\*?\}"

SQL_ELEMENTS = (
    r"""
WITH a AS (
  SELECT rec_no, regexp_replace(replace(content, chr(13) || chr(10), chr(10)), '(?ism)<!--.*?(?:-->|\z)|<nowiki>.*?</nowiki\s*>|^[ \t]*%[^\n]*', chr(2), 'g') AS t
  FROM sdv_full WHERE ns = 0 AND NOT starts_with(lower(content), '#redirect') AND NOT starts_with(content, '#重定向')),
code AS (SELECT rec_no, unnest(regexp_extract_all(t, '(?ism)"""
    + _CODE
    + r"""', 0)) AS x FROM a),
code_body AS (SELECT rec_no, x, regexp_extract(regexp_replace(regexp_replace(x, '(?i)^(?:<[^>]*>\s*(?:<code\b[^>]*>)?|[ \t]*(?:```|~~~)[^\n]*\n|\\begin\{\w+\})', ''), '(?i)(?:(?:</code\s*>)?\s*</\w+\s*>|[ \t]*(?:```|~~~)[ \t]*|\\end\{\w+\})$', ''), '\S[^\n]*', 0) AS l FROM code),
b AS (SELECT rec_no, regexp_replace(t, '(?ism)"""
    + _CODE
    + r"""', chr(2), 'g') AS t FROM a),
math AS (SELECT rec_no, unnest(regexp_extract_all(t, '(?is)"""
    + _MATH
    + r"""', 0)) AS x FROM b),
d AS (SELECT rec_no, regexp_replace(t, '(?is)"""
    + _MATH
    + r"""', chr(3), 'g') AS t FROM b),
formula AS (
  SELECT rec_no, regexp_replace(x, '(?is)^(?:<math\b[^>]*>|\$\$|\\\[|\\\(|\\begin\{equation\*?\})|(?:</math\s*>|\$\$|\\\]|\\\)|\\end\{equation\*?\})$', '', 'g') AS l FROM math
  UNION ALL SELECT rec_no, unnest(regexp_extract_all(t, '(?m)(?:^|[^\\$\w])\$([^\s$](?:[^$\n]*[^\s$\\])?)\$(?:[^\d$]|$)', 1)) FROM d),
e AS (SELECT rec_no, regexp_replace(t, '(?m)(^|[^\\$\w])\$[^\s$](?:[^$\n]*[^\s$\\])?\$([^\d$]|$)', '\1' || chr(3) || '\2', 'g') AS t FROM d),
raw AS (
  SELECT rec_no, 'heading' AS kind, unnest(regexp_extract_all(t, '(?m)^={1,6}[ \t]*([^=\s][^\n]*?)[ \t]*={1,6}[ \t]*$', 1)) AS l FROM e
  UNION ALL SELECT rec_no, 'heading', unnest(regexp_extract_all(t, '(?m)^([^\n=|{][^\n]*)\n(?:={2,}|-{2,})[ \t]*$', 1)) FROM e
  UNION ALL SELECT rec_no, 'heading', unnest(regexp_extract_all(t, '(?m)^ {0,3}#{2,6}[ \t]+([^\n]*?)(?:[ \t]#+)?[ \t]*$', 1)) FROM e
  UNION ALL SELECT rec_no, 'heading', unnest(regexp_extract_all(t, '(?is)<h[1-6]\b[^>]*>(.*?)</h[1-6]\s*>', 1)) FROM e
  UNION ALL SELECT rec_no, 'heading', unnest(regexp_extract_all(t, '\\(?:sub)*section\*?\{((?:[^{}]|\{[^{}]*\})*)\}', 1)) FROM e
  UNION ALL SELECT rec_no, 'list', unnest(regexp_extract_all(t, '(?m)^(?:\*[*#]*[ \t]*|#\**[ \t]*|[ \t]+\*[ \t]+)([^\s#*][^\n]*)', 1)) FROM e
  UNION ALL SELECT rec_no, 'list', unnest(regexp_extract_all(t, '(?m)^[ \t]*(?:[-+]|\d+[.)])[ \t]+(\S[^\n]*)', 1)) FROM e
  UNION ALL SELECT rec_no, 'list', regexp_extract(x, '(?is)^(.*?)(?:</li\s*>|</?[uo]l\b|\n[ \t]*\n|\z)', 1) FROM (SELECT rec_no, unnest(regexp_split_to_array(t, '(?i)<li\b[^>]*>')[2:]) AS x FROM e)
  UNION ALL SELECT rec_no, 'list', regexp_extract(x, '(?is)^(.*?)(?:\\end\{|\\begin\{|\n[ \t]*\n|\z)', 1) FROM (SELECT rec_no, unnest(regexp_split_to_array(t, '\\item\b')[2:]) AS x FROM e)),
link AS (SELECT rec_no, kind, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(l, '\[\[[^\[\]|]*\|([^\[\]]*)\]\]', '\1', 'g'), '\[\[([^\[\]|]*)\]\]', '\1', 'g'), '\[([^\[\]]*)\]\([^()\s]*\)', '\1', 'g'), '\\href\{(?:\\.|[^{}\\])*\}\{([^{}]*)\}', '\1', 'g'), '\\(?:text\w\w|emph)\{([^{}]*)\}', '\1', 'g') AS l FROM raw),
flat AS (SELECT rec_no, kind, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(l, '(?i)<br\b[^>]*>', ' ', 'g'), '</?[A-Za-z][^<>]*>', '', 'g'), '''{2,5}', '', 'g'), '\*{1,3}([^\s*](?:[^*\n]*[^\s*])?)\*{1,3}', '\1', 'g'), '(^|\W)_+([^\s_](?:[^\n_]*[^\s_])?)_+(\W|$)', '\1\2\3', 'g') AS l FROM link),
plain AS (SELECT rec_no, kind, regexp_replace(l, '\\([&%#$_{}])', '\1', 'g') AS l FROM flat UNION ALL SELECT rec_no, 'code', l FROM code_body WHERE starts_with(lower(x), '<pre')),
decoded AS (SELECT rec_no, kind, replace(replace(replace(replace(replace(replace(l, '&nbsp;', ' '), '&#39;', ''''), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&') AS l FROM plain
  UNION ALL SELECT rec_no, 'code', l FROM code_body WHERE NOT starts_with(lower(x), '<pre') UNION ALL SELECT rec_no, 'formula', l FROM formula)
SELECT DISTINCT rec_no, kind AS elem_kind, label FROM (SELECT rec_no, kind, trim(regexp_replace(replace(l, chr(160), ' '), '\s+', ' ', 'g')) AS label FROM decoded) WHERE label <> ''
"""
)
