"""Wordings of public error pages, script notices, fillers and unfilled fields, and ordinary sentences about such things.

FIRST was written before any form of the seed was tried on it, SECOND and THIRD each after the seed
had been widened by what the list before showed.
"""

FIRST = (
    "Error 500: the request handler failed.", "Please enable JavaScript to write a comment.", "The request timed out, for example at login.", "Sorry, an error occurred while loading.",
    "We are having trouble loading this page.", "Oops! That page can't be found.", "You need to enable JavaScript to run this app.", "Este sitio no está disponible.", "HTTP Error 502",
    "Hmm, we can't reach this page", "Your content will appear here", "This site can't be reached", "404 Not Found", "The requested URL was not found on this server.", "403 Forbidden",
    "You don't have permission to access this resource.", "500 Internal Server Error", "The server encountered an internal error or misconfiguration and was unable to complete your request.",
    "502 Bad Gateway", "503 Service Temporarily Unavailable", "504 Gateway Time-out", "Error establishing a database connection", "There has been a critical error on this website.",
    "This page isn't working", "The connection has timed out", "Secure Connection Failed", "Unable to connect", "Server Error in '/' Application.", "Whoops, something went wrong.",
    "Something went wrong. Please try again later.", "It looks like nothing was found at this location.", "This account has been suspended.", "Bandwidth Limit Exceeded", "Service Unavailable",
    "The service is temporarily unavailable.", "Briefly unavailable for scheduled maintenance.", "We'll be back soon!", "The site is currently down for maintenance.", "Access to this page has been denied.",
    "Sorry, you have been blocked", "Please verify you are a human", "Checking your browser before accessing the site.", "Too Many Requests", "Your session has expired. Please log in again.",
    "You must be logged in to view this page.", "This content is no longer available.", "The page you are looking for doesn't exist.", "Sorry, this page does not exist.", "This video is unavailable.",
    "The file you requested could not be found.", "Fatal error: Uncaught Error: Call to undefined function foo()", "Parse error: syntax error, unexpected end of file", "Warning: mysqli_connect(): Access denied for user",
    "Traceback (most recent call last):", "TypeError: Cannot read properties of undefined", "java.lang.OutOfMemoryError: Java heap space", "NullReferenceException: Object reference not set to an instance of an object.",
    "Segmentation fault (core dumped)", "Internal error. Try again.", "DNS_PROBE_FINISHED_NXDOMAIN", "ERR_CONNECTION_REFUSED", "Request Timeout", "Bad Request", "Method Not Allowed",
    "An unexpected error has occurred.", "We're sorry, but something went wrong.", "Application error: a client-side exception has occurred", "JavaScript is not available.",
    "We've detected that JavaScript is disabled in this browser.", "This page requires JavaScript.", "JavaScript must be enabled in order for you to use this site.", "Your browser does not support JavaScript!",
    "Please turn on cookies and reload the page.", "To view this page ensure that scripts are enabled.", "Your browser is out of date.", "This browser is no longer supported.", "Enable JavaScript and cookies to continue",
    "For full functionality of this site it is necessary to enable JavaScript.", "Lorem ipsum dolor sit amet, consectetur adipiscing elit.", "Sed ut perspiciatis unde omnis iste natus error sit voluptatem.",
    "Insert your text here.", "Click here to add text.", "Type something here...", "This is a sample page.", "Content goes here.", "Coming soon!", "Page under construction.", "Description to be added.", "TODO: write this section",
    "Hello {{first_name}}, welcome back.", "Dear [Name],", "${company.name} was founded by its owner.", "Welcome to %SITENAME%!", "<INSERT TITLE HERE>", "La page que vous recherchez n'existe pas.",
    "Erreur 404 : page non trouvée", "Seite nicht gefunden", "Diese Seite ist derzeit nicht verfügbar.", "Página no encontrada", "Страница не найдена", "ページが見つかりませんでした", "Для работы сайта включите JavaScript.",
    "Veuillez activer JavaScript dans votre navigateur.", "Bitte aktivieren Sie JavaScript in Ihrem Browser.", "Hier entsteht eine neue Internetpräsenz.",
)

ORDINARY = (
    "The committee denied access to the archive until 1950.", "He found an error in the census and corrected it.", "The server brought the soup to the table.", "Connection of the two lines failed for want of money.",
    "The mine was closed for maintenance in 1902 and reopened a year later.", "JavaScript was designed in ten days in 1995.", "Many browsers supported the plug-in before it was withdrawn.",
    "The phrase \"page not found\" became a joke among programmers.", "I got a 503 error yesterday when saving, is that known?", "Status code 418 stands for a teapot.", "A placeholder such as [Name] is filled by the mail program.",
    "The site of the old mill is no longer known.", "The test was repeated three times in the winter.", "Her text on the harbour is quoted here in full.", "The description of the bridge in the chronicle differs.",
    "The network of canals was enlarged in 1730.", "He could not find the page in the register.", "The error of the surveyor moved the border by a mile.", "The request of the monks was granted in 1411.", "The account of the siege was written by a monk.",
    "Trains no longer stop here since the station was closed.", "The host of the congress was the city.", "The service was suspended during the war.", "La page de titre porte une dédicace.", "Die Seite des Berges ist bewaldet.",
    "El servicio de trenes dejó de circular en 1970.", "Страница летописи утрачена.", "Requests to the council were seldom refused.", "The article on bridges was written in 1911.", "The script of the play was lost in the fire.",
    "Readers who have scripts disabled see a plain list.", "The title of the book was to be changed later.", "The content of the chest was listed in 1624.", "The system of locks failed in the flood of 1740.", "An example of this style stands in the square.",
)

SECOND = (
    "The link you followed may be broken, or the page may have been removed.", "We couldn't find the page you were looking for.", "Error code: 1020", "410 Gone", "401 Unauthorized", "The server is temporarily busy, try again later!",
    "Your request could not be processed.", "An error occurred while processing your request.", "This webpage is not available", "Connection reset by peer", "Failed to load resource: the server responded with a status of 404",
    "Internal Server Error", "The resource cannot be displayed because the server is not responding.", "Your connection was interrupted", "You are not authorized to view this page.", "You do not have sufficient permissions to access this page.",
    "We're currently performing scheduled maintenance.", "Sorry, we're doing some work on the site.", "The database server is not responding.", "Uncaught ReferenceError: x is not defined", "IndexError: list index out of range",
    "System.NullReferenceException at Page.Load", "Loading this page failed.", "This item has been removed or is no longer available.", "Please enable cookies.", "This site uses JavaScript, please enable it.", "JavaScript is turned off in your browser.",
    "Your browser is not supported.", "Turn on JavaScript to continue.", "Enter a description here", "Placeholder text", "Your name here", "This is dummy text.", "Text to be added", "Dear {customer_name},", "Hi [First Name]!", "Order number: {{ order.id }}",
    "Une erreur est survenue, veuillez réessayer.", "Es ist ein unerwarteter Fehler aufgetreten.", "Ha ocurrido un error inesperado.", "Произошла ошибка.", "アクセスが拒否されました", "Le service est temporairement indisponible.", "Zugriff verweigert",
    "Acceso denegado", "JavaScriptを有効にしてください。", "Blindtext", "Texto de prueba", "Votre texte ici", "Здесь будет текст",
)

THIRD = (
    "This page could not be loaded.", "Our servers are overloaded right now.", "There was a problem connecting to the server.", "Error 522: connection timed out", "The page you requested was not found.", "Unexpected server error.", "Oops, page not found!",
    "We are unable to process your request at this time.", "Your access to this site has been blocked.", "You don't have access to this document.", "HTTP 404", "Proxy Error", "Service is unavailable, try again in a moment.", "ValueError: invalid literal for int()",
    "Notice: Undefined variable: title in index.php", "This domain has expired.", "The website is under maintenance.", "You have JavaScript disabled.", "Scripts are blocked in your browser; allow them to see the map.", "Please upgrade your browser to view this content.",
    "Without JavaScript this page does not work.", "Add your text here", "Sample text", "Insert description here.", "This section is under construction.", "More information coming soon.", "Hello %USERNAME%,", "Sincerely, [Your Name]", "The total is {{amount}}.", "Page introuvable",
    "Die Seite wurde nicht gefunden.", "La página no existe.", "Доступ запрещён", "ただいまメンテナンス中です", "JavaScript está desactivado en su navegador.", "Cette page requiert JavaScript.", "Platzhaltertext", "Escriba su texto aquí", "Texte à compléter", "Ошибка 404",
)
